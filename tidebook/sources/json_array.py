"""Files that hold one JSON array of objects each, read by many tasks.

Spark's text source cuts a file at closing braces and splits it like any other text, so a task sees
pieces of the file in order, but not whether its first byte lies inside a string, or how deep. Both
are worked out by composition: for either answer to the first question, a task tells what its split
does to quoting and depth; the splits of a file, a row each, are then chained.

Within a split, objects end where depth is least, if they end there at all. Pieces are put together up
to these places under either assumption; only what crosses the border of a split (or of an object
larger than a split) has to be joined from several fragments afterwards. No task holds more than a
split, and no row more than an object.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.session import scratch_path, settle

SPLIT = ["_file", "_block"]


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between closing braces with the split it starts in and its order there."""
    text = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )


def _structure(value: Column) -> Column:
    """A piece without escapes. It starts after a brace, so an escape is never cut."""
    return F.regexp_replace(value, r"(?s)\\.", "")


def _opened(bare: Column, inside: Column) -> Column:
    """Opening braces of a piece outside strings."""
    plain = F.regexp_replace(F.concat(F.when(inside, '"').otherwise(""), bare), r'"[^"]*("|$)', "")
    return F.length(plain) - F.length(F.replace(plain, F.lit("{"), F.lit("")))


def _fragments(pieces: DataFrame) -> DataFrame:
    """Pieces put together up to where objects may end, for a split that starts outside (0) or inside (1) a string.

    For either: whether the fragment starts (s) and ends (e) where depth is least (m), how many
    objects ended before (g), the depth behind it (c) and whether its last brace closes one (k), relative
    to the split's start. A split's last piece stays by itself: at the end of a file no brace follows it.
    """
    order, whole = Window.partitionBy(*SPLIT).orderBy("_at"), Window.partitionBy(*SPLIT)
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    df = pieces.withColumn("_bare", _structure(F.col("value"))).withColumn("last", F.lead("_at").over(order).isNull())
    df = df.withColumn("_quotes", F.length("_bare") - F.length(F.replace("_bare", F.lit('"'), F.lit(""))))
    df = df.withColumn("_odd", F.pmod(F.coalesce(F.sum("_quotes").over(before), F.lit(0)), F.lit(2)))
    df = df.withColumn("odd", F.pmod(F.col("_odd") + F.col("_quotes"), F.lit(2)))
    both = lambda make: {k: v for h in (0, 1) for k, v in make(h).items()}
    # The brace behind a piece closes an object unless it lies in a string.
    df = df.withColumns(both(lambda h: {f"k{h}": F.col("odd") == h}))
    df = df.withColumns(both(lambda h: {f"_step{h}": _opened(F.col("_bare"), F.col("_odd") != h) - F.col(f"k{h}").cast("int")}))
    df = df.withColumns(both(lambda h: {f"c{h}": F.sum(f"_step{h}").over(upto)}))
    df = df.withColumns(both(lambda h: {f"m{h}": F.min(F.when(F.col(f"k{h}") & ~F.col("last"), F.col(f"c{h}"))).over(whole)}))
    ends = lambda h: ~F.col("last") & F.col(f"k{h}") & F.coalesce(F.col(f"c{h}") == F.col(f"m{h}"), F.lit(False))
    df = df.withColumns(both(lambda h: {f"e{h}": ends(h)}))
    df = df.withColumns(both(lambda h: {
        f"g{h}": F.coalesce(F.sum(F.col(f"e{h}").cast("int")).over(before), F.lit(0)),
        f"s{h}": F.coalesce(F.lag(f"e{h}").over(order), F.lit(False)),
    }))
    final = [F.max_by(c, "_at").alias(c) for c in ("c0", "c1", "m0", "m1", "k0", "k1", "e0", "e1", "odd")]
    starts = [F.min_by(c, "_at").alias(c) for c in ("s0", "s1")]
    parts = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "value"))), lambda p: p["value"]), "}")
    return df.groupBy(*SPLIT, "g0", "g1", "last").agg(F.min("_at").alias("_at"), parts.alias("text"), *final, *starts)


def _held(name: str) -> Column:
    """A fragment's column under the assumption that holds for its split."""
    return F.when(F.col("h") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


def _splits(fragments: DataFrame) -> DataFrame:
    """One row per split: which assumption holds, the depth it starts at, objects that ended before it."""
    in_file = Window.partitionBy("_file").orderBy("_block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    final = [F.max_by(c, "_at").alias(c) for c in ("c0", "c1", "m0", "m1", "k0", "k1", "odd")]
    df = fragments.groupBy(*SPLIT).agg(*(F.sum(F.col(f"e{h}").cast("int")).alias(f"n{h}") for h in (0, 1)), *final)
    df = df.withColumn("h", F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)))
    df = df.withColumn("depth", F.coalesce(F.sum(_held("c")).over(before), F.lit(0)))
    df = df.withColumn("ending", F.coalesce(_held("m") + F.col("depth") == 0, F.lit(False)))
    df = df.withColumn("tail", F.lead("_block").over(in_file).isNull())
    done = F.when(F.col("ending"), _held("n")).otherwise(0) + (_held("k") & (_held("c") + F.col("depth") == 0)).cast("int")
    return df.select(*SPLIT, "h", "depth", "ending", "tail", F.coalesce(F.sum(done).over(before), F.lit(0)).alias("objects"))


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(value): the text of every object of the arrays; anything that is not an array of objects fails the read."""
    fragments = settle(_fragments(_pieces(spark, path)), "json-fragments")
    known = fragments.join(_splits(fragments), SPLIT)
    ended = F.when(F.col("last"), ~F.col("tail") & _held("k") & (_held("c") + F.col("depth") == 0)).otherwise(F.col("ending") & _held("e"))
    number = F.col("objects") + F.when(F.col("ending"), _held("g")).otherwise(0)
    known = known.select(*SPLIT, "_at", "text", ended.alias("ended"), (F.col("ending") & _held("s")).alias("started"), number.alias("number"))
    whole = known.where("started AND ended").select("_file", "number", "text", "ended")
    # A few fragments per split: those that touch its borders. A file's last has no brace behind it.
    crossing = known.where("NOT (started AND ended)").groupBy("_file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_block", "_at", "text"))), lambda p: p["text"]), "}").alias("text"),
        F.bool_or("ended").alias("ended"),
    )
    first = F.col("number") == 0
    opening = F.when(first, F.lit(r"^\s*\[\s*\{")).otherwise(F.lit(r"^\s*,\s*\{"))
    closing = F.when(first, F.lit(r"^\s*(\[\s*\]\s*)?$")).otherwise(F.lit(r"^\s*\]\s*$"))
    good = F.regexp("text", F.when(F.col("ended"), opening).otherwise(closing))
    fault = F.concat(F.lit("malformed array of JSON objects: "), "_file", F.lit(", element "), F.col("number").cast("string"))
    element = F.concat(F.regexp_replace("text", r"^[\s,\[]*", ""), F.lit("}"))
    value = F.when(~good, F.raise_error(fault).cast("string")).when(F.col("ended"), element)
    return whole.unionByName(crossing).select(value.alias("value")).where("value IS NOT NULL")


def read_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The objects of the arrays as rows. Without a schema it is inferred from all of them."""
    elements = array_elements(spark, path)
    if schema is None:
        # Line breaks lie between tokens only; a string has them escaped.
        lines = scratch_path(spark, "json-lines")
        elements.select(F.translate("value", "\r\n", "  ")).write.text(lines)
        return spark.read.option("mode", "FAILFAST").json(lines)
    return elements.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
