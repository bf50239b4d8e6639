"""Tables that change as a whole: each load writes folders of its own, one small file then names the new version.

    <path>/rows/load=<id>/<partition>=<value>/   the rows of a partition as one load left them
    <path>/keys/load=<id>/<partition>=<value>/   their keys, sorted: which partitions hold a key
    <path>/versions/<number>.json                columns, and the load that each partition is read from

Readers see the version before a load or the one after it, whatever happens in between: a load that
is lost leaves folders nobody refers to. Loads write one after the other; one that finds its number
taken by another fails. On a store without rename, keep ``versions`` where there is one.

A load touches only partitions that gain, lose or change a row. Which those are is asked of the keys
alone, so a batch of rows told by key opens no other partition's rows. An added or dropped column is
a matter of the version: partitions that a load does not touch keep their files, and read as NULL in
columns that they were not written with, or that have been dropped since.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.operators.incremental import HIGH_WATER, KEY_DIFF, apply_rows, new_rows
from tidebook.session import settle
from tidebook.sources.sinks import gathered

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


class Lost(RuntimeError):
    """Another load has committed the version that this one was to become."""


class VersionedTable:
    """The table at ``path``; ``key`` for loads told by key, ``partition`` a date or integer column."""

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, partition: str | None = None):
        self.spark, self.path, self.key, self.partition = spark, path.rstrip("/"), key, partition
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._at = lambda *parts: hadoop.Path("/".join((self.path, *parts)))
        self._fs = self._at("versions").getFileSystem(spark._jsc.hadoopConfiguration())

    # --- versions ----------------------------------------------------------------

    def versions(self) -> list[int]:
        where = self._at("versions")
        if not self._fs.exists(where):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self) -> int | None:
        return max(self.versions(), default=None)

    def _manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no version of a table at {self.path}")
        lines = self.spark.read.option("wholetext", True).text(f"{self.path}/versions/{version:010d}.json")
        return json.loads(lines.first()[0])

    def _commit(self, version: int, schema: T.StructType, folders: dict[str, dict]) -> None:
        """The one step that makes a load visible."""
        draft, final = self._at("versions", f"{version:010d}.{uuid.uuid4().hex}"), self._at("versions", f"{version:010d}.json")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "folders": folders}).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Lost(f"version {version} of {self.path} is another load's")

    def drop_versions(self, keep: int = 2) -> int:
        """Forget all but the newest ``keep`` versions and remove what no version refers to.

        Returns the loads removed. Not while a load runs: its folders have no version yet.
        """
        kept = self.versions()[-keep:]
        used = {f["load"] for v in kept for f in self._manifest(v)["folders"].values()}
        for version in set(self.versions()) - set(kept):
            self._fs.delete(self._at("versions", f"{version:010d}.json"), False)
        gone = set()
        for part in ("rows", "keys"):
            if self._fs.exists(self._at(part)):
                for status in self._fs.listStatus(self._at(part)):
                    load = status.getPath().getName().removeprefix("load=")
                    if load not in used:
                        self._fs.delete(status.getPath(), True)
                        gone.add(load)
        return len(gone)

    # --- reading -----------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self._manifest(version)
        return self._rows(manifest, T.StructType.fromJson(manifest["schema"]), manifest["folders"])

    def _scan(self, part: str, schema: T.StructType, folders: dict[str, dict]) -> DataFrame:
        paths = [f"{self.path}/{part}/load={f['load']}/{name}".rstrip("/") for name, f in folders.items()]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{part}").parquet(*paths).select(*schema.names)

    def _rows(self, manifest: dict, schema: T.StructType, names: Iterable[str]) -> DataFrame:
        """Rows of some folders with the columns of ``schema``; one scan per set of columns that folders have."""
        alike: dict[tuple[str, ...], dict[str, dict]] = {}
        for name in names:
            folder = manifest["folders"][name]
            alike.setdefault(tuple(c for c in schema.names if c in folder["columns"]), {})[name] = folder
        out = self.spark.createDataFrame([], schema)
        for i, (columns, folders) in enumerate(alike.items()):
            held = T.StructType([schema[c] for c in columns])
            rows = self._scan("rows", held, folders)
            missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in columns]
            rows = rows.select("*", *missing).select(*schema.names)
            out = out.unionByName(rows) if i else rows
        return out

    def holding(self, keys: DataFrame, manifest: dict | None = None) -> list[str]:
        """The folders that hold one of ``keys``, by the sorted keys alone; their range goes to the scan."""
        manifest = manifest or self._manifest()
        schema = T.StructType.fromJson(manifest["schema"])
        low, high = keys.agg(F.min(self.key), F.max(self.key)).first()
        if low is None or not manifest["folders"]:
            return []
        held = self._scan("keys", T.StructType([schema[self.key], schema[self.partition]]), manifest["folders"])
        near = held.where(F.col(self.key).between(F.lit(low), F.lit(high)))
        found = near.join(keys.select(self.key), self.key, "left_semi").select(self.partition).distinct()
        return [self._name(r[0]) for r in found.collect()]  # a row per partition at most

    def _name(self, value: object) -> str:
        return f"{self.partition}={NULL_FOLDER if value is None else value}"

    # --- writing -----------------------------------------------------------------

    def _write(self, df: DataFrame) -> tuple[dict[str, dict], int]:
        """Write a load; what it holds by folder, and its rows."""
        load, seen = uuid.uuid4().hex, Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        folder = {"load": load, "columns": df.columns}
        if self.partition is None:
            counted.write.parquet(f"{self.path}/rows/load={load}")
            return {"": folder}, int(seen.get["rows"])
        if not isinstance(df.schema[self.partition].dataType, (T.DateType, T.IntegralType)):
            raise TypeError(f"{self.partition} must be a date or an integer")
        gathered(counted, self.partition).write.partitionBy(self.partition).parquet(f"{self.path}/rows/load={load}")
        where = self._at("rows", f"load={load}")
        names = [s.getPath().getName() for s in self._fs.listStatus(where)]
        folders = {n: folder for n in sorted(names) if n.startswith(f"{self.partition}=")}
        if self.key is not None and folders:
            written = self._scan("rows", df.schema, folders).select(self.key, self.partition)
            in_order = gathered(written, self.partition).sortWithinPartitions(self.partition, self.key)
            in_order.write.partitionBy(self.partition).parquet(f"{self.path}/keys/load={load}")
        return folders, int(seen.get["rows"])

    def replace(self, df: DataFrame) -> int:
        """Make ``df`` the whole table; returns its rows. The version before stays readable."""
        version = (self.version() or 0) + 1
        folders, rows = self._write(df)
        self._commit(version, df.schema, folders)
        return rows

    def publish(self, batch: DataFrame, ts: str = "order_ts", mode: str = KEY_DIFF) -> list[str]:
        """Apply a batch (see :func:`new_rows`) as the next version; returns the folders it touched.

        Columns follow the batch: added ones are NULL in old rows, dropped ones are gone. Only a column
        whose type changes makes the whole table be written anew.
        """
        last = self.version()
        if last is None:
            self.replace(batch)
            return sorted(self._manifest()["folders"])
        manifest = self._manifest(last)
        before, schema, batch = T.StructType.fromJson(manifest["schema"]), batch.schema, settle(batch, "batch")
        if any(f.name in before.names and before[f.name].dataType != f.dataType for f in schema):
            old = self.read(last)
            columns = [(F.col(f.name) if f.name in before.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
            merged = apply_rows(old.select(*columns), new_rows(old.select(*columns), batch, self.key, ts, mode), self.key)
            return self._become(last, schema, {}, settle(merged, "retyped"), manifest["folders"])
        if mode == HIGH_WATER and self.partition == "order_month":
            # The newest row is in the newest month, if a row has a month.
            dated = [n for n in manifest["folders"] if not n.endswith(NULL_FOLDER)]
            recent = [max(dated)] if dated else manifest["folders"]
        else:
            recent = self.holding(batch, manifest) if mode == KEY_DIFF else manifest["folders"]
        new = settle(new_rows(self._rows(manifest, schema, recent), batch, self.key, ts, mode), "new-rows")
        gaining = {self._name(r[0]) for r in new.select(self.partition).distinct().collect()}  # partitions
        touched = gaining | set(self.holding(new, manifest))
        if not touched and set(before.names) == set(schema.names):
            return []
        held = [n for n in sorted(touched) if n in manifest["folders"]]
        rest = {n: f for n, f in manifest["folders"].items() if n not in touched}
        return self._become(last, schema, rest, apply_rows(self._rows(manifest, schema, held), new, self.key), touched)

    def _become(self, last: int, schema: T.StructType, rest: dict[str, dict], rows: DataFrame, touched: Iterable[str]) -> list[str]:
        """The version after ``last``: ``rest`` as it was, ``rows`` written now."""
        kept = {n: {**f, "columns": [c for c in f["columns"] if c in schema.names]} for n, f in rest.items()}
        folders, _ = self._write(rows) if touched else ({}, 0)
        self._commit(last + 1, schema, {**kept, **folders})
        return sorted({*touched, *folders})


def replace_version(df: DataFrame, path: str) -> int:
    """:func:`tidebook.sources.replace_table` as a version: the old table is read until the new one is whole."""
    return VersionedTable(df.sparkSession, path).replace(df)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table at ``path``, versioned or a plain folder."""
    table = VersionedTable(spark, path)
    return spark.read.parquet(path) if table.version() is None else table.read()
