"""Session settings the jobs are written for, and where they keep settled data."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Runtime settings; all are ordinary Spark SQL options.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits a hot customer's partition on the fact side of the order join,
    # also when an aggregate on the same key follows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Building a plan makes hundreds of column calls; recording the Python call site
    # of each costs more than a small query takes to run.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidebook", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, which goes when Python
    ends: on a cluster such a folder would be visible to one machine only. A named folder
    is the caller's to empty, once no query reads what a job has settled there.
    """
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    root = tempfile.mkdtemp(prefix="tidebook-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled") -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the files.

    Used where several passes read one expensive result. The files outlive any
    executor, cut the lineage, and give later plans true sizes to broadcast by.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle_bucketed(df: DataFrame, column: str, buckets: int, label: str = "settled") -> DataFrame:
    """:func:`settle` into files bucketed by ``column``: a window or join by it reads them without a shuffle.

    The table is known to the catalog only until the scan is made; its files stay.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(buckets, column).sortBy(column).format("parquet")
    writer.option("path", scratch_path(spark, label)).saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def settle_counted(df: DataFrame, label: str = "settled") -> tuple[DataFrame, int]:
    """:func:`settle`, with the row count taken while writing (no second scan)."""
    seen = Observation()
    out = settle(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return out, int(seen.get["rows"])
