"""Global rank, ntile and running sums without a one-partition window.

A window without a partition key sends every row to one task. Here

* rows are ordered by ``(key, id)``, NULL keys last, keys compared in their own type: a
  key value shared by a third of all rows still splits, by id, and rows that share key
  and id are counted, not sorted;
* the rows at given ranks (tile ends, Pareto edges) are found by narrowing: a hash
  sample suggests cuts just around each wanted rank, one pass counts the rows between
  cuts, and only the intervals that hold a wanted rank go on. Samples decide how fast
  this narrows, never the result;
* tiles then follow from comparing each row with the tile ends: the rows themselves
  are neither shuffled nor sorted;
* ranks and running sums of all rows use Spark's range partitioning and per-range
  offsets; rows are shuffled once.

``df`` is read more than once: pass a table or a settled frame. The driver holds
counts per interval and bounded samples, nothing that grows with the data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cmp_to_key, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions import exact_units, from_units, no_units
from tidebook.session import settle, settle_bucketed

#: Rows one task may sort.
ROWS_PER_RANGE = 1_000_000
#: Sampled rows per interval and round; each round shrinks an interval about thirtyfold.
SAMPLE = 16_384
#: Offsets of this many ranges are sent to every task; more are joined.
BROADCAST_RANGES = 100_000
#: Buckets a written table may have (Spark's own limit unless set higher).
MOST_BUCKETS = 100_000


@dataclass(frozen=True)
class Ordering:
    """ORDER BY ``key`` [DESC] NULLS LAST, ``id``. Any orderable type; NaN is the largest number."""

    key: str
    id: str = "customer_id"
    descending: bool = False

    def columns(self, key: Column | None = None, id: Column | None = None) -> list[Column]:
        """What to sort by."""
        key = F.col(self.key) if key is None else key
        return [key.desc_nulls_last() if self.descending else key.asc_nulls_last(), F.col(self.id) if id is None else id]

    def after(self, place: Place, schema: T.StructType, key: Column | None = None) -> Column:
        """Whether a row comes later than ``place``; ``schema`` has the types of key and id."""
        key = F.col(self.key) if key is None else key
        later = F.col(self.id) > F.lit(place.id).cast(schema[self.id].dataType)
        if place.value is None:
            return key.isNull() & later
        at = F.lit(place.value).cast(schema[self.key].dataType)
        beyond = key < at if self.descending else key > at
        return F.when(key.isNull(), F.lit(True)).otherwise(beyond | ((key == at) & later))

    def compare(self, a: Place, b: Place) -> int:
        """As Spark would order two places."""
        if (a.value is None) != (b.value is None):
            return 1 if a.value is None else -1
        x, y = a.known_value(), b.known_value()
        if x != y:
            return (1 if x > y else -1) * (-1 if self.descending else 1)
        return (a.id > b.id) - (a.id < b.id)


@dataclass(frozen=True)
class Place:
    """Where a row stands in an ordering."""

    value: object
    id: object

    def known_value(self) -> tuple:
        """The value such that NaN equals itself and is the largest."""
        odd = isinstance(self.value, float) and math.isnan(self.value)
        return (self.value is None, odd, None if odd else self.value)


class _Search:
    """The hunt for the rows at some ranks of one ordering, whose key is column ``value``."""

    def __init__(self, df: DataFrame, number: int, ordering: Ordering, ranks: Sequence[int], rows: int):
        self.number, self.ordering, self.schema = number, ordering, df.schema
        self.value = f"_value{number}"
        self.ranks = sorted(set(ranks))
        self.cuts: list[Place] = []  # interval i lies after cuts[i - 1], up to and with cuts[i]
        self.sizes = {0: rows}

    def interval(self) -> Column:
        """The interval a row falls into: how many cuts lie before it."""
        steps = [self.ordering.after(c, self.schema, F.col(self.value)).cast("int") for c in self.cuts]
        return reduce(lambda a, b: a + b, steps, F.lit(0))

    def targets(self) -> dict[int, list[int]]:
        """Interval -> wanted ranks inside it, counted from its own start."""
        found: dict[int, list[int]] = {}
        before, waiting = 0, list(self.ranks)
        for i in range(len(self.cuts) + 1):
            size = self.sizes.get(i, 0)
            while waiting and waiting[0] <= before + size:
                found.setdefault(i, []).append(waiting.pop(0) - before)
            before += size
        return found

    def wide(self, limit: int) -> dict[int, list[int]]:
        """Intervals too large to be sorted by one task, with the ranks wanted there."""
        return {i: r for i, r in self.targets().items() if self.sizes[i] > limit}

    def sample(self, wide: dict[int, list[int]]) -> Column:
        """About SAMPLE rows of each wide interval, as one aggregate."""
        # Drawn by chance, row by row: rows that share key and id are not drawn together, and what
        # a rerun task draws instead changes the speed, not the result.
        at = self.interval()
        chance = reduce(lambda e, i: e.when(at == i, F.lit(SAMPLE / self.sizes[i])), wide, F.when(F.lit(False), 0.0))
        row = F.struct(at.alias("interval"), F.col(self.value).alias("value"), F.col(self.ordering.id).alias("id"))
        return F.collect_list(F.when(F.col(f"_chance{self.number}") < chance, row))

    def cut(self, sample: list, wide: dict[int, list[int]]) -> bool:
        """Cuts just around the wanted ranks; False if the sample cannot tell them from their neighbours."""
        in_order = cmp_to_key(self.ordering.compare)
        by_interval: dict[int, list[Place]] = {}
        for row in sample:
            by_interval.setdefault(row["interval"], []).append(Place(row["value"], row["id"]))
        cuts = {(c.known_value(), c.id): c for c in self.cuts}
        for i, places in by_interval.items():
            places.sort(key=in_order)
            for rank in wide[i]:
                share = rank / self.sizes[i]
                middle = share * len(places)
                slack = 4 * math.sqrt(len(places) * share * (1 - share)) + 2
                for at in (math.floor(middle - slack), math.ceil(middle + slack)):
                    if 0 <= at < len(places):
                        cuts.setdefault((places[at].known_value(), places[at].id), places[at])
        if len(cuts) == len(self.cuts):
            return False
        self.cuts = sorted(cuts.values(), key=in_order)
        return True

    def merge_idle(self, sizes: dict[int, int]) -> None:
        """Take the intervals' sizes; forget cuts between intervals that hold no wanted rank."""
        self.sizes = sizes
        held = self.targets()
        cuts, merged, size = [], {}, 0
        for i in range(len(self.cuts) + 1):
            size += self.sizes.get(i, 0)
            if i == len(self.cuts) or i in held or i + 1 in held:
                merged[len(cuts)] = size
                size = 0
                if i < len(self.cuts):
                    cuts.append(self.cuts[i])
        self.cuts, self.sizes = cuts, merged

    def found(self, left: DataFrame) -> dict[int, Place]:
        """Rank -> place. Sorts what is left, one task per interval; equal rows are one row with a count."""
        targets = self.targets()
        id, value = F.col(self.ordering.id), F.col(self.value)
        left = left.withColumn("_interval", self.interval()).where(F.col("_interval").isin(sorted(targets)))
        counted = left.groupBy("_interval", value, id).agg(F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("_interval").orderBy(*self.ordering.columns(value, id))
        counted = counted.withColumn("_upto", F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
        wanted = [(i, offset) for i, offsets in sorted(targets.items()) for offset in offsets]
        hit = [(F.col("_interval") == i) & (F.col("_upto") >= o) & (F.col("_upto") - F.col("_n") < o) for i, o in wanted]
        rows = counted.where(reduce(or_, hit)).collect()  # a row per wanted rank at most
        ranks = dict(zip(wanted, self.ranks, strict=True))
        return {
            rank: next(Place(r[self.value], r[self.ordering.id]) for r in rows if r["_interval"] == i and r["_upto"] - r["_n"] < o <= r["_upto"])
            for (i, o), rank in ranks.items()
        }


def _narrow(rows: DataFrame, searches: Sequence[_Search], limit: int, turn: int) -> bool:
    """One round for all searches: a pass that samples, a pass that counts. False when nothing is left to narrow."""
    wide = {s.number: w for s in searches if (w := s.wide(limit))}
    if not wide:
        return False
    active = [s for s in searches if s.number in wide]
    drawn = rows.select("*", *(F.rand(turn * len(searches) + s.number).alias(f"_chance{s.number}") for s in active))
    samples = drawn.agg(*(s.sample(wide[s.number]).alias(f"s{s.number}") for s in active)).first()  # bounded by SAMPLE
    # The samples of an ordering may not tell a wanted rank from its neighbours: then it is time to sort.
    cut = [s for s in active if s.cut(samples[f"s{s.number}"], wide[s.number])]
    if not cut:
        return False
    each = F.explode(F.array(*(F.struct(F.lit(s.number).alias("search"), s.interval().alias("interval")) for s in cut)))
    counted = rows.select(each.alias("at")).groupBy("at.search", "at.interval").agg(F.count(F.lit(1)).alias("n")).collect()
    for s in cut:  # a few intervals per wanted rank
        s.merge_idle({r["interval"]: r["n"] for r in counted if r["search"] == s.number})
    return True


def places_at(
    df: DataFrame,
    wanted: Sequence[tuple[Ordering, Sequence[int]]],
    rows: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> list[list[Place]]:
    """The places of the rows at the given 1-based ranks (at most ``rows``), exactly.

    All orderings are searched in the same passes. Each round keeps a few percent of the rows, so a
    billion rows take two rounds before what is left is written once, for one task per interval to sort.
    """
    rows = df.count() if rows is None else rows
    if rows == 0 or not any(ranks for _, ranks in wanted):
        return [[] for _ in wanted]
    ranks: dict[Ordering, list[int]] = {}
    for ordering, some in wanted:
        ranks.setdefault(ordering, []).extend(some)
    searches = {o: _Search(df, i, o, r, rows) for i, (o, r) in enumerate(ranks.items()) if r}
    keys = [F.col(s.ordering.key).alias(s.value) for s in searches.values()]
    read = df.select(*keys, *dict.fromkeys(o.id for o in searches))
    turn = 0
    while _narrow(read, list(searches.values()), rows_per_range, turn):
        turn += 1
    left = read
    if turn and len(searches) > 1:
        wide = [s.interval().isin(sorted(s.targets())) for s in searches.values()]
        left = settle(read.where(reduce(or_, wide)), "left")
    places = {o: s.found(left) for o, s in searches.items()}
    return [[places[o][rank] for rank in some] for o, some in wanted]


def tile_ends(rows: int, tiles: int) -> list[int]:
    """Last rank of tiles 1 .. tiles-1; the first ``rows % tiles`` get one row more."""
    base, extra = divmod(rows, tiles)
    return [t * base + min(t, extra) for t in range(1, tiles)]


def distributed_ntile(
    df: DataFrame,
    tiles: Sequence[tuple[str, int, Ordering]],
    rows: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``NTILE(n) OVER (ORDER BY ...)`` columns, given as ``(name, n, ordering)``.

    A row's tile is the number of tile ends before it, plus one.
    """
    rows = df.count() if rows is None else rows
    found = places_at(df, [(o, tile_ends(rows, n) if rows else []) for _, n, o in tiles], rows, rows_per_range)
    columns = []
    for (name, _, ordering), ends in zip(tiles, found):
        beyond = [ordering.after(end, df.schema).cast("int") for end in ends]
        columns.append(reduce(lambda a, b: a + b, beyond, F.lit(1)).alias(name))
    return df.select("*", *columns)


def prefix_sum(
    df: DataFrame,
    value: str | None,
    ordering: Ordering,
    rows: int | None = None,
    rank_name: str = "rank",
    sum_name: str = "running",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add the global rank, and the running sum of the money column ``value``.

    Rows are range-partitioned and sorted once and written with their position, so
    positions stay what they are however often later stages are retried. What lies
    before each range is added from a table with a row per range.
    """
    rows = df.count() if rows is None else rows
    ranges = max(1, rows // rows_per_range)
    units = F.coalesce(exact_units(F.col(value)), no_units()) if value else F.lit(0).cast("bigint")
    # The id holds the partition above bit 33 and the position in it below.
    position = F.monotonically_increasing_id()
    placed = (
        df.withColumn("_units", units)
        .repartitionByRange(ranges, *ordering.columns())
        .sortWithinPartitions(*ordering.columns())
        .withColumn("_position", position)
        .withColumn("_range", F.shiftright("_position", 33).cast("int"))
        .withColumn("_row", F.col("_position").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(1))
    )
    # The running sum goes range by range: files that are bucketed by range need no second shuffle.
    placed = settle_bucketed(placed, "_range", min(ranges, MOST_BUCKETS), "ranked") if value else settle(placed, "ranked")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_units").alias("s"))
        .select(
            "_range",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_units_before"),
        )
    )
    out = placed.join(F.broadcast(offsets) if ranges <= BROADCAST_RANGES else offsets, "_range")
    added = [(F.col("_row") + F.col("_rows_before")).alias(rank_name)]
    if value:
        so_far = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
        added.append(from_units(F.sum("_units").over(so_far) + F.col("_units_before")).alias(sum_name))
    return out.select(*df.columns, *added)


def distributed_rank(df: DataFrame, ordering: Ordering, rows: int | None = None, name: str = "rank") -> DataFrame:
    """Add ``ROW_NUMBER() OVER (ORDER BY ...)``."""
    return prefix_sum(df, None, ordering, rows, rank_name=name)
