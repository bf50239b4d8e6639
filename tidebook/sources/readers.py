"""Landing: typed reads, flattening, the audit stamp, and full-replace loads."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.sources.json_array import read_array
from tidebook.sources.schemas import EVENT_FIELDS, RAW_SCHEMAS


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Header CSV. Without a schema every row is inspected to infer the types."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path)
    return reader.schema(schema).csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Files that hold one JSON array of objects each, of any size: many tasks read a file.

    A file that holds anything else, or anything after its array, fails the read instead of
    losing rows; a blank file is an empty array. See :mod:`tidebook.sources.json_array`.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return read_array(spark, path, schema)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def flatten(df: DataFrame, column: str, fields: Mapping[str, str] = EVENT_FIELDS) -> DataFrame:
    """Lift ``fields`` of a nested object to top-level columns.

    ``column`` is a struct, or a string with JSON text.
    """
    is_text = isinstance(df.schema[column].dataType, T.StringType)

    def pick(name: str, kind: str) -> Column:
        value = F.get_json_object(column, f"$.{name}") if is_text else F.col(column)[name]
        return value.cast(kind).alias(name)

    kept = [F.col(c) for c in df.columns if c != column]
    return df.select(*kept, *[pick(n, k) for n, k in fields.items()])


def stamp(df: DataFrame, column: str = "_ingested_at") -> DataFrame:
    """Add the load time; one value for the whole load."""
    return df.withColumn(column, F.current_timestamp())


def replace_table(df: DataFrame, path: str) -> int:
    """Replace the Parquet table at ``path``; returns the rows written.

    The count is observed on the write itself, so nothing is scanned twice.
    Replaces the whole table whatever the session's partition overwrite mode is.
    """
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )
    return int(seen.get["rows"])


def row_floor(count: int, minimum: int = 50_000) -> str:
    """``warn`` when a load is suspiciously small; never fails the load."""
    return "warn" if count < minimum else "pass"


def land(
    spark: SparkSession, source_dir: str, landed_dir: str, events: str = "array", replace: Callable[[DataFrame, str], int] = replace_table
) -> dict[str, int]:
    """Land the five CSV extracts and the JSON events; returns rows per table.

    ``replace`` writes a table to a path: :func:`replace_table`, which overwrites in place, or
    ``tidebook.operators.versions.replace_version``, by which readers keep the old table until the new one is whole.

    ``events`` names the form of ``events.json``: an ``array``, or ``lines``, which are read in one pass.
    """
    if events not in ("array", "lines"):
        raise ValueError(f"events come as 'array' or 'lines', not {events!r}")
    read_events = read_json_array if events == "array" else read_json_lines
    counts = {}
    for name, schema in RAW_SCHEMAS.items():
        if name == "events":
            rows = flatten(read_events(spark, f"{source_dir}/events.json", schema), "properties")
        else:
            rows = read_csv(spark, f"{source_dir}/{name}.csv", schema)
        counts[name] = replace(stamp(rows), f"{landed_dir}/{name}")
    return counts
