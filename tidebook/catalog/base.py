"""Registration of queries, and the inputs they start from."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from tidebook.catalog.oracle import CTES
from tidebook.operators.staging import Staged
from tidebook.plans.warehouse import Warehouse
from tidebook.sources import bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Once(dict):
    """A dict that builds a missing entry on first use."""

    def __init__(self, build: Callable[[str], DataFrame]):
        super().__init__()
        self._build = build

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]


@lru_cache(maxsize=4)
def bound_inputs(spark: SparkSession, sf_dir: str) -> tuple[Once, Staged]:
    """Raw and staged frames of a scale factor. These are definitions: no data is kept,
    and every query still reads the base tables itself."""
    raw = Once(lambda name: bindings.RAW[name](spark, sf_dir))
    return raw, Staged.from_raw(raw)


class Bound:
    """The base tables of one scale factor as raw, staged and mart frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw, self.staged = bound_inputs(spark, sf_dir)
        self.wh = Warehouse(self.staged)

    def raw_all(self) -> dict[str, DataFrame]:
        return {name: self.raw[name] for name in bindings.RAW}

    def table(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self.sf_dir, name)


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the shared table expressions it mentions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, sql in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(sql)
                needed.append(name)

    visit(body)
    parts = [f"{name} AS (\n{CTES[name].strip()}\n)" for name in needed]
    body = body.strip()
    if body.upper().startswith("WITH "):
        first, body = body[5:], ""
        return "WITH " + ",\n".join([*parts, first])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def add(name: str, build: Callable[[Bound], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = lambda spark, sf_dir: build(Bound(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = with_ctes(sql)
