"""Distributed ranking against ordinary windows, on data built to break it."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidebook.operators import ranking
from tidebook.operators.ranking import Ordering, distributed_ntile, distributed_rank, places_at, prefix_sum, tile_ends
from tidebook.session import settle


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, some are NULL, some negative."""
    df = spark.range(3000).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 0.0)
        .when(F.col("id") % 17 == 0, None)
        .otherwise(F.round(F.sin("id") * 1000, 2))
        .alias("v"),
    )
    return settle(df)


@pytest.fixture(autouse=True, params=[16_384, 400])
def sample(request, monkeypatch):
    """Everything holds with small samples too, which take several rounds to narrow."""
    monkeypatch.setattr(ranking, "SAMPLE", request.param)


def same(df, a, b):
    return df.where(~F.col(a).eqNullSafe(F.col(b))).count() == 0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("per_range", [100, 10**6])
def test_ntile_equals_the_window(skewed, descending, per_range):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    got = distributed_ntile(skewed, [("t", 10, Ordering("v", descending=descending))], rows_per_range=per_range)
    both = got.withColumn("w", F.ntile(10).over(Window.orderBy(order, "customer_id")))
    assert same(both, "t", "w")


@pytest.mark.parametrize("n", [0, 1, 9, 10, 23])
def test_ntile_of_few_rows(skewed, n):
    few = skewed.where(F.col("customer_id") < n)
    got = distributed_ntile(few, [("t", 10, Ordering("v"))], rows_per_range=2)
    both = got.withColumn("w", F.ntile(10).over(Window.orderBy(F.col("v").asc_nulls_last(), "customer_id")))
    assert both.count() == n and same(both, "t", "w")


def test_all_ties_are_split_by_id(spark):
    df = settle(spark.range(1000).select(F.col("id").alias("customer_id"), F.lit(5.0).alias("v")))
    got = distributed_ntile(df, [("t", 7, Ordering("v"))], rows_per_range=50)
    both = got.withColumn("w", F.ntile(7).over(Window.orderBy("v", "customer_id")))
    assert same(both, "t", "w")


@pytest.mark.parametrize("per_range", [40, 10**6])
def test_rank_and_running_sum_equal_the_window(skewed, per_range):
    w = Window.orderBy(F.col("v").desc_nulls_last(), "customer_id")
    got = prefix_sum(skewed, "v", Ordering("v", descending=True), rows_per_range=per_range)
    exact = F.sum(F.coalesce(F.col("v"), F.lit(0.0)).cast("decimal(18,4)")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    both = got.withColumn("k", F.row_number().over(w)).withColumn("s", exact.cast("double"))
    assert both.count() == 3000
    assert same(both, "rank", "k") and same(both, "running", "s")


def test_string_ids_work(spark):
    df = settle(spark.range(500).select(F.concat(F.lit("k'\"\\"), F.col("id").cast("string")).alias("who"), (F.col("id") % 5).alias("v")))
    got = distributed_rank(df, Ordering("v", id="who"), name="r")
    got2 = distributed_ntile(df, [("t", 4, Ordering("v", id="who"))], rows_per_range=30)
    w = Window.orderBy("v", "who")
    assert same(got.withColumn("w", F.row_number().over(w)), "r", "w")
    assert same(got2.withColumn("w", F.ntile(4).over(w)), "t", "w")


def test_places_of_the_first_and_last_rank(skewed):
    first, last = places_at(skewed, [(Ordering("customer_id"), [1, 3000])], rows_per_range=100)[0]
    assert (first.id, last.id) == (0, 2999)


def test_tile_sizes_differ_by_at_most_one():
    for n in (0, 1, 9, 10, 23, 1000):
        ends = [0, *tile_ends(n, 10), n]
        sizes = [b - a for a, b in zip(ends, ends[1:])]
        assert sum(sizes) == n and sorted(sizes, reverse=True) == sizes and max(sizes) - min(sizes) <= 1


def test_ranking_plan_has_no_single_partition_sort(skewed):
    plan = distributed_ntile(skewed, [("t", 10, Ordering("v"))], rows_per_range=100)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Window" not in plan


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize(
    "kind",
    [
        "CAST(id * 3 + 9007199254740990 AS BIGINT)",
        "date_add(DATE '2020-01-01', CAST(id % 97 AS INT))",
        "CAST(timestamp_seconds(id * 1000) AS TIMESTAMP_NTZ)",
        "CAST(id % 50 AS DECIMAL(38,10)) / 7",
        "concat('k', id % 40)",
        "CASE id % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN -double(id) ELSE double(id) END",
    ],
)
def test_keys_compare_in_their_own_type(spark, kind, descending):
    df = settle(spark.range(900).selectExpr("id AS customer_id", f"CASE WHEN id % 11 <> 0 THEN {kind} END AS v"))
    ordering = Ordering("v", descending=descending)
    w = Window.orderBy(F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last(), "customer_id")
    tiles = distributed_ntile(df, [("t", 7, ordering)], rows_per_range=60)
    assert same(tiles.withColumn("w", F.ntile(7).over(w)), "t", "w")
    ranks = distributed_rank(df, ordering, name="r")
    assert same(ranks.withColumn("w", F.row_number().over(w)), "r", "w")


def test_neighbours_beyond_the_range_of_doubles(spark):
    df = settle(spark.createDataFrame([(1, 9007199254740993), (2, 9007199254740992)], "customer_id long, v long"))
    got = {r["customer_id"]: r["r"] for r in distributed_rank(df, Ordering("v"), name="r").collect()}
    assert got == {2: 1, 1: 2}


def test_repeated_key_and_id_are_counted(spark):
    """Two thirds of all rows share key and id; no cut can part them."""
    df = settle(spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE 500 END AS customer_id", "CASE WHEN id % 3 = 0 THEN id % 9 ELSE 4 END AS v"))
    ends = places_at(df, [(Ordering("v"), [1, 1000, 1500, 3000])], rows_per_range=100)[0]
    rows = df.orderBy("v", "customer_id").collect()
    assert [(p.value, p.id) for p in ends] == [(rows[k - 1]["v"], rows[k - 1]["customer_id"]) for k in (1, 1000, 1500, 3000)]


def test_passes_do_not_grow_with_the_orderings(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SAMPLE", 400)
    columns = [F.sin("id") * 100, F.pmod("id", F.lit(7)).cast("double"), -F.col("id").cast("double"), F.cos("id")]
    base = settle(spark.range(4000).select(F.col("id").alias("customer_id"), *(c.alias(f"v{i}") for i, c in enumerate(columns))))

    def rows_read(n):
        seen = spark.sparkContext.accumulator(0)

        def tell(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        read = base.mapInArrow(tell, base.schema)
        orderings = [Ordering(f"v{i}", descending=i == 3) for i in range(n)]
        places = places_at(read, [(o, [400, 2000, 3999]) for o in orderings], 4000, rows_per_range=1000)
        for o, found in zip(orderings, places, strict=True):
            order = Window.orderBy(*o.columns())
            ranked = base.withColumn("r", F.row_number().over(order)).where("r IN (400, 2000, 3999)").orderBy("r")
            assert [(r[o.key], r["customer_id"]) for r in ranked.collect()] == [(p.value, p.id) for p in found]
        return seen.value

    one, four = rows_read(1), rows_read(4)
    assert four <= one + 3 * 4000  # a round more at most, and what is left is written once


def test_running_sums_shuffle_the_rows_once(spark, skewed):
    """What is written is bucketed by range, so that the window needs no exchange of its own."""
    got = prefix_sum(skewed, "v", Ordering("v", descending=True), rows_per_range=300)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "hashpartitioning(_range" not in plan.split("BroadcastExchange")[0]
    order = Window.orderBy(F.col("v").desc_nulls_last(), "customer_id")
    want = F.sum(F.coalesce(F.col("v"), F.lit(0.0)).cast("decimal(20,2)")).over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("double")
    both = got.withColumn("w", want).withColumn("p", F.row_number().over(order))
    assert both.where("rank <> p OR abs(running - w) > 1e-9").count() == 0 and both.count() == 3000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ranked")]
