"""One array file read by many tasks equals json.loads, wherever the file is cut."""

from __future__ import annotations

import json
import random

import pytest

from tidebook.sources import read_json_array
from tidebook.sources.json_array import array_elements


@pytest.fixture
def cut(spark):
    """Cut files every so many bytes."""

    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def texts(seed):
    r = random.Random(seed)
    odd = ['"', "\\", "{", "}", "[", "]", ",", "}{", '"}', '\\"', "\n", "é🙂", "word", " "]
    return lambda: "".join(r.choice(odd) for _ in range(r.randint(0, 12)))


def objects(seed, n):
    r, text = random.Random(seed), texts(seed)

    def value(depth):
        kind = r.randint(0, 5 if depth < 3 else 2)
        if kind == 0:
            return r.randint(-9, 9)
        if kind <= 2:
            return text()
        if kind == 3:
            return [value(depth + 1) for _ in range(r.randint(0, 3))]
        return {text(): value(depth + 1) for _ in range(r.randint(0, 3))}

    return [{"id": i, "v": value(0)} for i in range(n)]


def parsed(spark, path):
    return sorted((json.loads(r[0]) for r in array_elements(spark, str(path)).collect()), key=lambda o: o["id"])


@pytest.mark.parametrize("size", [11, 64, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_any_cut(spark, tmp_path, cut, size, indent):
    want = objects(size, 8 if size < 64 else 40)
    (tmp_path / "a.json").write_text(json.dumps(want, indent=indent, ensure_ascii=False) + "\n")
    cut(size)
    assert parsed(spark, tmp_path) == want


def test_many_files_and_an_object_larger_than_splits(spark, tmp_path, cut):
    want = [{"id": i, "v": [{"deep": "}" * i}] * (300 if i == 3 else 1)} for i in range(8)]
    (tmp_path / "a.json").write_text(json.dumps(want[:5]))
    (tmp_path / "b.json").write_text(json.dumps(want[5:]))
    (tmp_path / "empty.json").write_text(" [ \n ] ")
    (tmp_path / "blank.json").write_text("\n")
    (tmp_path / "nothing.json").write_text("")
    cut(200)
    assert parsed(spark, tmp_path) == want


def test_one_file_is_many_tasks(spark, tmp_path, cut):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "v": "x" * 50} for i in range(2000)]))
    cut(10_000)
    scan = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert scan.rdd.getNumPartitions() >= 10
    assert read_json_array(spark, str(tmp_path), "id bigint, v string").selectExpr("sum(id)", "count(*)").first() == (1999000, 2000)


@pytest.mark.parametrize(
    "text",
    ['[{"id": 1}', '[{"id": 1}] x', '[{"id": 1},]', '[{"id": 1} {"id": 2}]', '[{"id": {"a": 1}]', '{"id": 1}\n{"id": 2}\n'],
)
@pytest.mark.parametrize("size", [5])
def test_anything_else_fails(spark, tmp_path, cut, text, size):
    (tmp_path / "a.json").write_text(text)
    cut(size)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_json_array(spark, str(tmp_path), "id bigint").collect()


def test_inferred_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text('[\n{"a": 1,\n "b": "x\\ny"},\n{"c": 1.5}\n]')
    got = read_json_array(spark, str(tmp_path))
    assert sorted((r["a"], r["b"], r["c"]) for r in got.where("a = 1").collect()) == [(1, "x\ny", None)] and got.count() == 2
