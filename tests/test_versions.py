from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_incremental import BATCH, DIFF, HIGH, LOADED, PEOPLE, fact, state

from fixtures import order, staged
from tidebook.operators.incremental import HIGH_WATER, KEY_DIFF
from tidebook.operators.versions import Lost, VersionedTable, read_table, replace_version
from tidebook.sources.schemas import ORDERS
from tidebook.streaming import order_stream, run_incremental


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "fct"), "order_id", "order_month")


@pytest.mark.parametrize("mode, want", [(HIGH_WATER, HIGH), (KEY_DIFF, DIFF)])
def test_loads_replays_and_earlier_versions(spark, rows, table, mode, want):
    table.publish(fact(spark, LOADED), mode=mode)
    first = state(table.read(), rows)
    for _ in range(2):  # the second finds nothing to do
        table.publish(fact(spark, BATCH), mode=mode)
        assert state(table.read(), rows) == want
    assert table.versions() == [1, 2] and state(table.read(1), rows) == first


def spoil(path, months, part="rows"):
    """Whoever opens a file of these months fails."""
    for month in months:
        for file in path.glob(f"{part}/load=*/order_month={month}/*.parquet"):
            file.write_bytes(b"not a parquet file")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_only_months_that_hold_a_key_are_opened(spark, rows, table, tmp_path):
    many = [order(m * 10 + i, 1, f"2024-{m:02d}-{i + 1:02d} 10:00", float(m)) for m in range(1, 13) for i in range(5)]
    table.publish(fact(spark, many))
    spoil(tmp_path / "fct", [f"2024-{m:02d}-01" for m in range(1, 13) if m not in (3, 7)])
    # A replay, a change that keeps its time, and a late row: March and July are all there is to see.
    lot = [order(30, 1, "2024-03-01 10:00", 3.0), order(72, 1, "2024-07-03 10:00", 7.0, "refunded"), order(500, 1, "2024-03-09 10:00", 1.0)]
    touched = table.publish(fact(spark, lot))
    assert touched == ["order_month=2024-03-01", "order_month=2024-07-01"]
    now = table.read().where("order_month IN (DATE '2024-03-01', DATE '2024-07-01')")
    got = {r["order_id"]: r["status"] for r in now.collect()}
    assert got[72] == "refunded" and len(got) == 11
    loads = {f["load"] for n, f in table._manifest()["folders"].items() if n not in touched}
    assert loads == {f["load"] for f in table._manifest(1)["folders"].values()}


def test_a_row_that_moves_leaves_its_month(spark, rows, table):
    table.publish(fact(spark, LOADED))
    touched = table.publish(fact(spark, [order(1, 1, "2024-03-02 10:00", 11.0)]))
    assert touched == ["order_month=2024-01-01", "order_month=2024-03-01"]
    assert "order_month=2024-01-01" not in table._manifest()["folders"]
    assert state(table.read(), rows) == [(1, 11.0, "completed"), (2, 20.0, "completed"), (3, 30.0, "completed")]


@pytest.mark.parametrize("load", ["replace", "publish"])
def test_a_load_lost_before_its_commit_changes_nothing(spark, rows, table, monkeypatch, load):
    table.publish(fact(spark, LOADED))
    before = state(table.read(), rows)

    def die(*_):
        raise RuntimeError("executor, driver or network lost")

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, "_commit", die)
        with pytest.raises(RuntimeError, match="lost"):
            getattr(table, load)(fact(spark, BATCH))
    assert state(table.read(), rows) == before and table.versions() == [1]
    getattr(table, load)(fact(spark, BATCH))
    assert len(state(table.read(), rows)) == (6 if load == "publish" else len(BATCH))
    assert state(table.read(1), rows) == before
    assert table.drop_versions(keep=1) >= 1  # with the old version the lost load's folders go
    assert table.versions() == [2]
    assert len(state(table.read(), rows)) == (6 if load == "publish" else len(BATCH))


def test_a_reader_keeps_its_version_while_a_load_runs(spark, rows, table):
    table.publish(fact(spark, LOADED))
    open_reader = table.read()
    table.replace(fact(spark, BATCH))
    assert len(state(open_reader, rows)) == len(LOADED)


def test_two_loads_cannot_become_one_version(spark, table):
    table.publish(fact(spark, LOADED))
    manifest = table._manifest()
    schema = table.read().schema
    table._commit(2, schema, manifest["folders"])
    with pytest.raises(Lost):
        table._commit(2, schema, manifest["folders"])
    assert table.versions() == [1, 2]


def test_added_and_dropped_columns_touch_no_old_month(spark, rows, table):
    table.publish(fact(spark, LOADED))
    loads = {n: f["load"] for n, f in table._manifest()["folders"].items()}
    late = [order(9, 2, "2024-03-05 10:00", 90.0)]
    added = fact(spark, late).withColumn("currency", F.lit("EUR")).drop("discount_pct")
    assert table.publish(added) == ["order_month=2024-03-01"]
    assert rows(table.read(), "order_id", "currency") == [(1, None), (2, None), (3, None), (9, "EUR")]
    assert "discount_pct" not in table.read().columns and "discount_pct" in table.read(1).columns
    assert {n: f["load"] for n, f in table._manifest()["folders"].items() if n in loads} == loads
    # Back again: what old months held before the drop stays dropped.
    again = fact(spark, [order(10, 2, "2024-04-05 10:00", 1.0)]).withColumn("discount_pct", F.lit(0.5))
    assert table.publish(again) == ["order_month=2024-04-01"]
    assert rows(table.read(), "order_id", "discount_pct") == [(1, None), (2, None), (3, None), (9, None), (10, 0.5)]
    assert {n: f["load"] for n, f in table._manifest()["folders"].items() if n in loads} == loads
    assert "currency" not in table.read().columns


def test_a_column_alone_makes_a_version(spark, table):
    table.publish(fact(spark, LOADED))
    assert table.publish(fact(spark, LOADED).drop("discount_pct")) == []
    assert "discount_pct" not in table.read().columns and table.read().count() == 3


def test_rows_differ_by_an_added_column_alone(spark, rows, table):
    table.publish(fact(spark, LOADED))
    changed = F.when(F.col("order_id") == 2, "EUR")
    assert table.publish(fact(spark, LOADED).withColumn("currency", changed)) == ["order_month=2024-02-01"]
    assert rows(table.read(), "order_id", "currency") == [(1, None), (2, "EUR"), (3, None)]


def test_a_changed_type_rewrites_everything(spark, rows, table):
    table.publish(fact(spark, LOADED))
    table.publish(fact(spark, BATCH).withColumn("net_amount", F.col("net_amount").cast("decimal(18,2)")))
    assert [float(r[1]) for r in rows(table.read(), "order_id", "net_amount")] == [11.0, 20.0, 30.0, 40.0, 50.0, 60.0]


def test_rows_without_a_month_and_empty_loads(spark, rows, table):
    undated = fact(spark, LOADED).withColumn("order_month", F.when(F.col("order_id") > 1, F.col("order_month")))
    table.publish(undated)
    assert rows(table.read(), "order_id", "order_month")[0] == (1, None)
    table.publish(fact(spark, LOADED))
    assert all(r[1] is not None for r in rows(table.read(), "order_id", "order_month")) and table.read().count() == 3
    assert table.publish(fact(spark, [])) == []
    table.replace(fact(spark, []))
    assert table.read().count() == 0
    table.publish(fact(spark, LOADED))
    assert table.read().count() == 3


def test_stream_of_files_in_any_order(spark, rows, tmp_path):
    inbox, target, log = (str(tmp_path / n) for n in ("inbox", "fct", "log"))
    customers = staged(spark, customers=PEOPLE).customers
    for lot in (LOADED, BATCH):
        spark.createDataFrame(lot, ORDERS).coalesce(1).write.mode("append").option("header", True).csv(inbox)
        for _ in range(2):
            stream = order_stream(spark, inbox, files_per_batch=1)
            run_incremental(stream, customers, target, log, versioned=True).awaitTermination()
    assert state(VersionedTable(spark, target).read(), rows) == DIFF


def test_plain_tables_as_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "landed")
    assert replace_version(spark.range(5).toDF("n"), path) == 5
    monkeypatch.setattr(VersionedTable, "_commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        replace_version(spark.range(9).toDF("n"), path)
    assert read_table(spark, path).count() == 5
    spark.range(3).write.parquet(str(tmp_path / "folder"))
    assert read_table(spark, str(tmp_path / "folder")).count() == 3
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, str(tmp_path / "none")).read()
