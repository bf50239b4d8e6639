"""Tables laid out for looking up one key: folders by the key's hash, rows sorted by key within.

A lookup opens the files of one folder, and in them the row groups whose range of keys and Bloom
filter allow the key. A key with a large share of all rows fills several files of its folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.sources.sinks import gathered

SLOT = "_slot"
#: Folders of a table, and bytes of a row group: small groups are skipped more precisely.
SLOTS, GROUP_BYTES = 256, 16 << 20


class LookupTable:
    """The table at ``path`` by ``key``. Write and read it with the same number of ``slots``."""

    def __init__(self, spark: SparkSession, path: str, key: str = "customer_id", slots: int = SLOTS):
        self.spark, self.path, self.key, self.slots = spark, path, key, slots

    def _slot(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.slots)).cast("int")

    def write(self, df: DataFrame) -> None:
        placed = gathered(df.withColumn(SLOT, self._slot(F.col(self.key))), SLOT).sortWithinPartitions(SLOT, self.key)
        writer = placed.write.mode("overwrite").partitionBy(SLOT)
        writer = writer.option(f"parquet.bloom.filter.enabled#{self.key}", "true").option("parquet.block.size", GROUP_BYTES)
        writer.option("partitionOverwriteMode", "static").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(SLOT)

    def of(self, value: object) -> DataFrame:
        """The rows of one key; the folder is a constant by the time files are listed."""
        rows = self.spark.read.parquet(self.path)
        kind = rows.schema[self.key].dataType
        wanted = F.lit(value).cast(kind)
        return rows.where((F.col(SLOT) == self._slot(wanted)) & (F.col(self.key) == wanted)).drop(SLOT)
