"""Quality rules with robust multivariate outliers. DataFrame functions only.

Every text gets its word statistics. Texts that fail the base rules are out. The others are judged
by how unusual their statistics are for their language and source: the vector of

    mean word length (log), symbols per word (log), share of repeated lines, share of repeated words

is fitted in each group by the minimum covariance determinant: from starts at medians, lower and
upper quartiles with interquartile ranges, concentration steps take the ``SUBSET`` of texts nearest
to the current centre and refit centre and covariance on them. The start that ends with the least
determinant is the group's; one reweighting step follows. Half of a group may be junk. A text is
rejected if its Mahalanobis distance exceeds what ``CUTOFF`` (a chi-squared quantile) allows.

A step is one pass over the vectors (four integers a text, written once): rows are summed by group
and distance bin before they are shuffled, so a source with a third of all rows is a few hundred
rows per task. Vectors are whole multiples of 1/``UNITS`` and sums are decimals: results do not
depend on the order of rows. Short texts' ratios are drawn to the group's, and every statistic has
a least deviation, so that a group of near-identical texts rejects nobody for a trifle. Groups
below ``LEAST_GROUP`` texts are judged with the small groups of their language, and these, if still
too few, with all such.

A null or empty text has no words and fails the base rules. Null languages and sources are groups
of their own. Rows repeated in the input are repeated in the result. Windows are compared by 64-bit
hashes. Only key, language and source of the input are carried along.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidebook.llm.common import SPACE, let, settle, settle_with

SYMBOLS = "#*$%&|<>"
WORDS_PER_WINDOW = 5
#: Base rules: fewest words, most repeated words in percent.
LEAST_WORDS, MOST_REPEATED = 10, 20
UNITS = 1024
STEPS, SUBSET, LEAST_GROUP = 4, 0.5, 50
#: Which quartile of each statistic a start is centred on; the first one wins ties.
STARTS = (1, 0, 2)
#: 0.975 and 0.9999 quantiles of chi-squared with four degrees of freedom.
INNER, CUTOFF = 11.143, 23.513
#: What the covariance of that share of a normal sample is multiplied by to be the whole one's.
SUBSET_FACTOR, INNER_FACTOR = 2.1091, 1.0645
#: Least standard deviation of each statistic, in its own unit.
LEAST_DEVIATION = (0.04, 0.05, 0.08, 0.05)
#: Words and lines that a text's ratios are completed with.
PRIOR_LENGTH_WORDS, PRIOR_WORDS, PRIOR_LINES = 50, 20, 5
#: Group tables up to this size are sent to every task; larger ones are joined by shuffling.
BROADCAST_GROUPS = 10_000
BINS_PER_DOUBLING = 64
X = [f"x{i}" for i in range(4)]


def repeated_words(words: Column) -> Column:
    """Words in windows of five that occur twice or more; linear but for one sort of the windows."""
    size = WORDS_PER_WINDOW

    def covered(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            again = F.filter(
                F.transform(
                    s,
                    lambda e, j: F.when((e["h"] == F.get(s, j - 1)["h"]) | (e["h"] == F.get(s, j + 1)["h"]), e["i"]),
                ),
                lambda i: i.isNotNull(),
            )
            return F.array_sort(again)

        steps = lambda p: F.transform(p, lambda v, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1) - v, F.lit(size))))
        return F.aggregate(let(let(ordered, places), steps), F.lit(0), lambda a, v: a + v)

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(
        hashes,
        lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(size)))),
    )
    some = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)))
    return F.when(F.size(words) <= size, F.lit(0)).otherwise(some)


def statistics(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words (long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, SPACE), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    symbols = reduce(add, (F.length(body) - F.length(F.replace(body, F.lit(s), F.lit(""))) for s in SYMBOLS))
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), repeated_words(w).alias("again")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    out = df.select(*keep, symbols.alias("n_symbols"), of_words.alias("w"), of_lines.alias("l"))
    return out.select(
        *keep,
        F.col("w.n").cast("long").alias("n_words"),
        F.col("w.chars").cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.col("l.n").cast("long").alias("n_lines"),
        F.col("l.again").cast("long").alias("n_dup_lines"),
        F.col("w.again").cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def to_groups(rows: DataFrame, groups: DataFrame, n_groups: int, on: list[str]) -> DataFrame:
    """``rows`` with their group's columns. Null keys match."""
    side = groups.select(*(F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in groups.columns))
    side = F.broadcast(side) if n_groups <= BROADCAST_GROUPS else side
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on))
    return rows.join(side, same, "left").drop(*(f"_{c}" for c in on))


def grouped(stats: DataFrame, by: list[str]) -> tuple[DataFrame, int]:
    """(``by``, group, mean_length) of every combination, and their number."""
    fit = stats.where(~base_failed())
    sums = [F.count(F.lit(1)).alias("n"), F.sum("word_chars").alias("chars"), F.sum("n_words").alias("words")]
    cells = settle(fit.groupBy(*by).agg(*sums), "cells")
    small = F.col("n") < LEAST_GROUP
    language = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy(by[0]))
    name = F.when(~small, F.to_json(F.struct(*by))).when(language >= LEAST_GROUP, F.to_json(F.struct(by[0]))).otherwise(F.lit("{}"))
    named = cells.withColumn("group", name)
    means = named.groupBy("group").agg((F.sum("chars") / F.sum("words")).alias("mean_length"))
    return settle_counted(named.select(*by, "group").join(means, "group"), "groups")


def settle_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    out, seen = settle_with(df, label, n=F.count(F.lit(1)))
    return out, seen["n"]


def vectors() -> list[Column]:
    words, lines = F.col("n_words"), F.col("n_lines")
    length = F.log((F.col("word_chars") + PRIOR_LENGTH_WORDS * F.col("mean_length")) / (words + PRIOR_LENGTH_WORDS))
    values = [
        length,
        F.log1p(F.col("n_symbols") / (words + PRIOR_WORDS)),
        F.col("n_dup_lines") / (lines + PRIOR_LINES),
        F.col("n_repeat_words") / (words + PRIOR_WORDS),
    ]
    return [F.round(v * UNITS).cast("long").alias(x) for v, x in zip(values, X, strict=True)]


def squared_distance() -> Column:
    """Mahalanobis, by forward substitution with the Cholesky factor l.. and centre m.. of the row's group."""
    y: list[Column] = []
    for i in range(4):
        rest = F.col(X[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * y[j]
        y.append(rest / F.col(f"l{i}{i}"))
    return reduce(add, (v * v for v in y))


def factored(moments: DataFrame, factor: float) -> DataFrame:
    """Centre and Cholesky factor per group (and start) from n, s. (sums) and q.. (sums of products)."""
    keys = [c for c in ("group", "start") if c in moments.columns]
    out = moments.select(*keys, *((F.col(f"s{i}") / F.col("n")).cast("double").alias(f"m{i}") for i in range(4)), "n", *(f"q{i}{j}" for i in range(4) for j in range(i + 1)))
    for i in range(4):
        for j in range(i + 1):
            cov = factor * (F.col(f"q{i}{j}").cast("double") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
            if i == j:
                cov = F.greatest(cov, F.lit(0.0)) + (LEAST_DEVIATION[i] * UNITS) ** 2
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), cov)
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}"))
    return out.select(*keys, *(f"m{i}" for i in range(4)), *(f"l{i}{j}" for i in range(4) for j in range(i + 1)))


def moments() -> list[Column]:
    whole = [F.col(x).cast("decimal(20,0)") for x in X]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(whole)]
    return [F.count(F.lit(1)).alias("n"), *sums, *(F.sum((F.col(X[i]) * F.col(X[j])).cast("decimal(20,0)")).alias(f"q{i}{j}") for i in range(4) for j in range(i + 1))]


def concentrated(rows: DataFrame, params: DataFrame, n_groups: int) -> DataFrame:
    """Moments of the nearest ``SUBSET`` of each group and start, distances in narrow bins, the last one whole."""
    binned = to_groups(rows, params, n_groups, ["group"])
    binned = binned.withColumn("bin", F.floor(F.log2(1 + squared_distance()) * BINS_PER_DOUBLING))
    cells = binned.groupBy("group", "start", "bin").agg(*moments())
    upto = Window.partitionBy("group", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("group", "start")
    cells = cells.withColumns({"before": F.coalesce(F.sum("n").over(upto), F.lit(0)), "total": F.sum("n").over(all_of)})
    inside = cells.where(F.col("before") < F.ceil(F.col("total") * SUBSET))
    sums = ["n", *(f"s{i}" for i in range(4)), *(f"q{i}{j}" for i in range(4) for j in range(i + 1))]
    return inside.groupBy("group", "start").agg(*(F.sum(c).alias(c) for c in sums))


def least_determinant(params: DataFrame) -> DataFrame:
    """The start of each group that ended with the least determinant, the first of equal ones."""
    size = F.round(reduce(add, (F.log(F.col(f"l{i}{i}")) for i in range(4))), 9)
    every = F.struct(size.alias("size"), *(c for c in params.columns if c != "group"))
    return params.groupBy("group").agg(F.min(every).alias("best")).select("group", *(f"best.{c}" for c in params.columns if c not in ("group", "start")))


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", by: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """``key``, ``by``, the statistics, base_failed, distance (squared; null if base_failed), kept."""
    by = list(by)
    stats = settle(statistics(df.select(key, *by, text), [key, *by], text), "statistics")
    groups, n_groups = grouped(stats, by)
    rows = to_groups(stats, groups, n_groups, by)
    rows = settle(rows.select("*", base_failed().alias("base_failed"), *vectors()), "vectors")

    fit = rows.where(~F.col("base_failed")).select("group", *X)
    quarters = [F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(x) for x in X]
    start = fit.groupBy("group").agg(*quarters)
    spread = [F.greatest((F.col(x)[2] - F.col(x)[0]) / 1.349, F.lit(d * UNITS)) for x, d in zip(X, LEAST_DEVIATION, strict=True)]
    lower = [(spread[i] if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(4) for j in range(i + 1)]
    centres = F.array(*(F.struct(F.lit(k).alias("start"), *(F.col(x)[quarter].alias(f"m{i}") for i, x in enumerate(X))) for k, quarter in enumerate(STARTS)))
    params = settle(start.select("group", *lower, F.inline(centres)), "centres")
    for _ in range(STEPS):
        params = settle(factored(concentrated(fit, params, n_groups), SUBSET_FACTOR), "centres")
    params = settle(least_determinant(params), "centres")
    near = to_groups(fit, params, n_groups, ["group"]).where(squared_distance() <= INNER)
    params = settle(factored(near.groupBy("group").agg(*moments()), INNER_FACTOR), "centres")

    judged = to_groups(rows, params, n_groups, ["group"])
    distance = F.when(~F.col("base_failed"), squared_distance())
    judged = judged.withColumn("distance", distance)
    stat = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance") > CUTOFF, F.lit(False))
    return judged.select(key, *by, *stat, "n_lines", "base_failed", "distance", kept.alias("kept"))
