"""Personal data by candidates and boosted trees. DataFrame functions only.

High-recall generators propose spans that may overlap: the base patterns of each kind, and wider
ones (addresses with written-out signs or letters of any script, numbers with dots or doubled
blanks, national phone numbers, version 6 addresses). Base matches that pass their check (parts of
an address, Luhn digits, number of digits) are personal data. Boosted trees, fitted by histograms
that Spark aggregates, learn from the format and the context of base matches which of them pass;
held-out rows calibrate a threshold for each kind; what the wider generators propose, or failed a
check but looks like those that pass, is added from that threshold on. Added spans do not lie within
a base one, which they may extend, and do not overlap each other: from left to right, each begins
after the last one taken.

Training takes the base matches of every text: one pass sums them by features, and trees and
thresholds come from those sums. Texts are scanned and scored row by row, without a shuffle. Positions are code points. A null or empty text has no spans; a kind without failing or
passing examples adds nothing below a score of one half. Repeated rows give repeated results.
Very long texts: all patterns are possessive or bounded, so time is linear in the text.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import let, settle

KINDS = ("email", "ip", "card", "phone")
#: Base patterns, as given, in a form that Java's matcher takes in linear time: a match of the first
#: part begins where a run of its characters begins or the last match ended, and what is repeated at
#: the end is never given back.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = [
    ("email", r"(?<![^\s@<>\"'(),;:])[^\s@<>\"'(),;:]++@[^\s@<>\"'(),;:]*?\.\p{L}{2,24}(?!\p{L})"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]\x20?(?:at|@)\x20?[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]\x20?dot\x20?[\])])\x20?[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9A-Za-z])[0-9](?:[\x20._-]{0,2}[0-9]){11,18}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z+.])(?:\(?[0-9]{2,4}\)?[\x20./-]){1,4}[0-9]{3,5}(?![0-9A-Za-z])"),
]
CONTEXT = 24
CUES = r"(?i)(?:tel|fon|phone|call|mobil|fax|mail|card|visa|kart|carte|tarjeta|address|host|server)[^\n]{0,12}$"
SECRETS = r"(?i)(?:token|key|password|secret|hash|version|license|commit|id)[^\n]{0,8}$"
#: Boosting: trees, their depth, shrinkage, ridge; values a feature takes; precision asked for.
TREES, DEPTH, SHRINKAGE, RIDGE = 8, 3, 0.5, 1.0
LARGEST_VALUE, PRECISION = 40, 0.95
PREFIX_BLOCK, NOWHERE = 128, -(1 << 30)
HELD_OUT = 5
FEATURES = ("kind", "length", "digits", "letters", "others", "groups", "distinct", "first", "plus", "bracket", "before", "after", "cue", "secret")


def folded(values: Column, op, zero: Column) -> Column:
    """``op`` over the elements before each element, in blocks: n times the block size, never n squared."""
    total = lambda a: F.aggregate(a, zero, op)
    size = F.lit(PREFIX_BLOCK)

    def within(v: Column) -> Column:
        count = F.floor((F.size(v) + PREFIX_BLOCK - 1) / PREFIX_BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: total(F.slice(v, b * size + 1, size)))
        starts = lambda s: F.transform(s, lambda _, b: total(F.slice(s, F.lit(1), b)))
        block = lambda i: F.floor(i / PREFIX_BLOCK).cast("int")
        each = lambda st: F.transform(v, lambda _, i: op(F.get(st, block(i)), total(F.slice(v, block(i) * size + 1, i % PREFIX_BLOCK))))
        return F.when(F.size(v) == 0, F.slice(v, 1, 0)).otherwise(let(let(blocks, starts), each))

    return let(values, within)


def prefix_sums(values: Column) -> Column:
    return folded(values, lambda a, b: a + b, F.lit(0))


def prefix_max(values: Column) -> Column:
    return folded(values, lambda a, b: F.greatest(a, b), F.lit(NOWHERE))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start, end, what, and the context before and after."""

    def located(parts: Column) -> Column:
        def placed(found: Column) -> Column:
            steps = F.transform(found, lambda m, i: F.length(F.get(parts, i)) + F.length(m))

            def spans(sums: Column) -> Column:
                def span(m: Column, i: Column) -> Column:
                    start = F.get(sums, i) + F.length(F.get(parts, i))
                    return F.struct(
                        start.alias("start"),
                        (start + F.length(m)).alias("end"),
                        m.alias("what"),
                        F.right(F.get(parts, i), F.lit(CONTEXT)).alias("left"),
                        F.left(F.get(parts, i + 1), F.lit(1)).alias("next"),
                    )

                return F.transform(found, span)

            return let(prefix_sums(steps), spans)

        return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)

    return let(F.split(text, pattern, -1), located)


def digits(what: Column) -> Column:
    return F.regexp_replace(what, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether 12 to 19 digits have a sum of tens: every second one from the right doubled, its digits added."""
    n = F.length(number)

    def total(d: Column) -> Column:
        size = F.length(d)

        def step(s: Column, i: Column) -> Column:
            digit = F.substr(d, size - i + 1, F.lit(1)).cast("int")
            twice = digit * 2
            return s + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

        return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), step) % 10 == 0

    return F.when(n.between(12, 19), let(number, total)).otherwise(F.lit(False))


def passes(kind: str, what: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: let(F.regexp_replace(p, "^0+(?=.)", ""), lambda z: F.when(F.length(z) <= 3, z.cast("int") <= 255).otherwise(F.lit(False)))
        return F.forall(F.split(what, "\\."), small)
    if kind == "card":
        return luhn(digits(what))
    return F.length(digits(what)).between(9, 15)


def candidates(text: Column, wide: bool = True) -> Column:
    """All proposals of a text, or only those of base patterns: kind (number), start, end, what, left,
    next, base (from a base pattern), passed."""

    def of(kind: str, pattern: str, base: bool) -> Column:
        def kept(m: Column) -> Column:
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["what"].alias("what"),
                m["left"].alias("left"),
                m["next"].alias("next"),
                F.lit(base).alias("base"),
                (passes(kind, m["what"]) if base else F.lit(False)).alias("passed"),
            )

        return F.transform(matches(text, pattern), kept)

    every = [of(k, p, True) for k, p in BASE.items()] + [of(k, p, False) for k, p in WIDE if wide]
    nothing = F.filter(of("email", BASE["email"], True), lambda _: F.lit(False))
    # Every pattern needs a digit or an at sign, written out or not.
    return F.when(text.rlike("[0-9@]|(?i)[\\[(] ?at ?[\\])]"), F.concat(*every)).otherwise(F.slice(nothing, 1, 0))


def features(c: Column) -> dict[str, Column]:
    """What the trees see of a candidate: whole numbers from 0 to ``LARGEST_VALUE``."""
    what, only = c["what"], digits(c["what"])
    count = lambda pattern: F.length(what) - F.length(F.regexp_replace(what, pattern, ""))
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    word = "[\\p{L}\\p{N}_]"
    found = {
        "kind": c["kind"],
        "length": F.length(what),
        "digits": F.length(only),
        "letters": count("\\p{L}"),
        "others": count("[^\\p{L}0-9]"),
        "groups": F.size(F.regexp_extract_all(what, F.lit("[0-9]+"), F.lit(0))),
        "distinct": F.size(F.array_distinct(F.split(only, ""))),
        "first": F.coalesce(F.try_to_number(F.substring(only, 1, 1), F.lit("9")).cast("int"), F.lit(0)),
        "plus": flag(what.startswith("+")),
        "bracket": flag(F.contains(what, F.lit("("))),
        "before": flag(F.right(c["left"], F.lit(1)).rlike(word)) + 2 * flag(F.right(c["left"], F.lit(1)).rlike("[=\"'.:/-]")),
        "after": flag(c["next"].rlike(word)) + 2 * flag(c["next"].rlike("[=\"'@:/-]")),
        "cue": flag(c["left"].rlike(CUES)),
        "secret": flag(c["left"].rlike(SECRETS)),
    }
    return {k: F.least(found[k], F.lit(LARGEST_VALUE)).cast("int") for k in FEATURES}


@dataclass
class Tree:
    """Inner nodes (feature, largest value that goes left) and leaves, by heap number."""

    splits: dict[int, tuple[str, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def value(self, of, node: int = 1) -> Column:
        if node not in self.splits:
            return F.lit(self.leaves.get(node, 0.0))
        name, cut = self.splits[node]
        return F.when(of(name) <= cut, self.value(of, 2 * node)).otherwise(self.value(of, 2 * node + 1))

    def node(self, of, node: int = 1) -> Column:
        if node not in self.splits:
            return F.lit(node)
        name, cut = self.splits[node]
        return F.when(of(name) <= cut, self.node(of, 2 * node)).otherwise(self.node(of, 2 * node + 1))


@dataclass
class Model:
    trees: list[Tree]
    thresholds: list[float]

    def probability(self, of) -> Column:
        margin = reduce(add, (t.value(of) for t in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-margin))


def grow(rows: DataFrame, trees: list[Tree]) -> Tree:
    """The next tree: level by level, gradients are summed by node, feature and value in one aggregation.

    At most nodes x features x values sums reach the driver. They are of whole millionths, so the
    order of rows does not matter."""
    tree, open_nodes = Tree(), [1]
    p = Model(trees, []).probability(F.col)
    whole = lambda x: F.round(x * 1_000_000).cast("long")
    for _ in range(DEPTH):
        seen = rows.where(tree.node(F.col).isin(open_nodes)).select(
            tree.node(F.col).alias("node"),
            whole(F.col("times") * (F.col("passed") - p)).alias("g"),
            whole(F.col("times") * p * (1 - p)).alias("h"),
            F.posexplode(F.array(*FEATURES)).alias("feature", "value"),
        )
        sums = seen.groupBy("node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        following = []
        for node in open_nodes:
            of_node = [r for r in sums if r["node"] == node]
            if not of_node:
                continue
            first = [r for r in of_node if r["feature"] == 0]
            g_all, h_all = sum(r["g"] for r in first) / 1e6, sum(r["h"] for r in first) / 1e6
            tree.leaves[node] = SHRINKAGE * g_all / (h_all + RIDGE)
            best = (1e-3, None)
            for i, name in enumerate(FEATURES):
                g = h = 0.0
                for r in sorted((r for r in of_node if r["feature"] == i), key=lambda r: r["value"])[:-1]:
                    g, h = g + r["g"] / 1e6, h + r["h"] / 1e6
                    gain = g * g / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                    if gain > best[0] + 1e-9:
                        best = (gain, (name, r["value"], g, h))
            if best[1] is not None:
                name, cut, g, h = best[1]
                tree.splits[node] = (name, cut)
                tree.leaves[2 * node] = SHRINKAGE * g / (h + RIDGE)
                tree.leaves[2 * node + 1] = SHRINKAGE * (g_all - g) / (h_all - h + RIDGE)
                following += [2 * node, 2 * node + 1]
        open_nodes = following
        if not open_nodes:
            break
    return tree


def calibrated(rows: DataFrame, model: Model) -> list[float]:
    """For each kind the least score from which held-out candidates reach ``PRECISION``, one half at least."""
    binned = rows.select("kind", "passed", "times", F.round(model.probability(F.col), 3).alias("score"))
    cells = binned.groupBy("kind", "score").agg(F.sum(F.col("passed") * F.col("times")).alias("true"), F.sum("times").alias("all"))
    found = cells.collect()
    out = []
    for kind in range(len(KINDS)):
        threshold, true, every = 2.0, 0, 0
        for r in sorted((r for r in found if r["kind"] == kind and r["score"] >= 0.5), key=lambda r: -r["score"]):
            true, every = true + r["true"], every + r["all"]
            if true >= PRECISION * every:
                threshold = r["score"]
        out.append(max(threshold, 0.5) if threshold <= 1 else threshold)
    return out


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Fit trees and thresholds on the base candidates of all rows of ``df``."""
    part = F.pmod(F.xxhash64(key, text), F.lit(1 << 20))
    base = df.select(part.alias("part"), F.explode(candidates(F.coalesce(F.col(text), F.lit("")), wide=False)).alias("c"))
    seen = base.select((F.col("part") % HELD_OUT == 0).alias("held"), F.col("c.passed").cast("int").alias("passed"), *(v.alias(k) for k, v in features(F.col("c")).items()))
    rows = settle(seen.groupBy("held", "passed", *FEATURES).agg(F.count(F.lit(1)).alias("times")), "pii-training")
    model = Model([], [])
    for _ in range(TREES):
        model.trees.append(grow(rows.where("not held"), model.trees))
    model.thresholds = calibrated(rows.where("held"), model)
    return model


def detect(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``spans``: arrays of (start, kind number, end) by start, then kind.
    Input columns of these names are replaced."""
    place = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))

    def score(c: Column) -> Column:
        return let(F.struct(*(v.alias(k) for k, v in features(c).items())), lambda f: model.probability(lambda name: f[name]))

    def enough(c: Column) -> Column:
        threshold = F.element_at(F.array(*(F.lit(float(t)) for t in model.thresholds)), c["kind"] + 1)
        return score(c) >= threshold

    # Spans in order of start, base ones first: what lies within a base span is told from the furthest end before.
    ordered = lambda base, more: F.array_sort(F.concat(F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("added"), b["end"].alias("end"), b["kind"].alias("kind"))), more))
    ends_of_base = lambda u: prefix_max(F.transform(u, lambda e: F.when(e["added"] == 0, e["end"]).otherwise(F.lit(NOWHERE))))

    def free(union: Column) -> Column:
        reaching = lambda ends: F.filter(F.transform(union, lambda e, i: F.when((e["added"] == 1) & (e["end"] > F.get(ends, i)), e)), lambda e: e.isNotNull())
        return let(ends_of_base(union), reaching)

    def apart(more: Column) -> Column:
        """From left to right, what begins after the last one taken; in blocks, so that lists are short."""
        spans = "array<struct<start:int,added:int,end:int,kind:int>>"
        state = lambda reach, taken: F.struct(reach.alias("reach"), taken.alias("taken"))
        size = F.lit(PREFIX_BLOCK)

        def step(done: Column, e: Column) -> Column:
            fits = e["start"] >= done["reach"]
            return state(F.when(fits, e["end"]).otherwise(done["reach"]), F.when(fits, F.concat(done["taken"], F.array(e))).otherwise(done["taken"]))

        def block(done: Column, b: Column) -> Column:
            within = F.aggregate(F.slice(more, b * size + 1, size), state(done["reach"], F.array().cast(spans)), step)
            return let(within, lambda w: state(w["reach"], F.concat(done["taken"], F.array(w["taken"]))))

        count = F.floor((F.size(more) + PREFIX_BLOCK - 1) / PREFIX_BLOCK).cast("int")
        start = state(F.lit(0), F.array().cast(f"array<{spans}>"))
        return F.aggregate(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), start, block, lambda d: F.flatten(d["taken"]))

    def chosen(all_of: Column) -> Column:
        def both(base: Column) -> Column:
            more = F.filter(all_of, lambda c: F.when(c["passed"], F.lit(False)).otherwise(enough(c)))
            more = F.array_distinct(F.transform(more, lambda c: F.struct(c["start"].alias("start"), F.lit(1).alias("added"), c["end"].alias("end"), c["kind"].alias("kind"))))
            added = let(let(ordered(base, more), free), apart)
            return F.struct(base.alias("base"), F.array_sort(F.concat(base, F.transform(added, place))).alias("spans"))

        return let(F.array_sort(F.transform(F.filter(all_of, lambda c: c["passed"]), place)), both)

    keep = [c for c in df.columns if c not in ("base", "spans")]
    found = let(candidates(F.coalesce(F.col(text), F.lit(""))), chosen)
    return df.select(*(F.col(f"`{c}`") for c in keep), found.alias("_found")).select(*(F.col(f"`{c}`") for c in keep), "_found.base", "_found.spans")


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    name = lambda s: F.element_at(F.array(*(F.lit(k) for k in KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans are one, of the first's kind."""
    mark = lambda s: F.concat(F.lit("["), F.upper(F.element_at(F.array(*(F.lit(k) for k in KINDS)), s["kind"] + 1)), F.lit("]"))

    def step(done: Column, s: Column) -> Column:
        reach = done["reach"]
        gap = F.substr(text, reach + 1, F.greatest(s["start"] - reach, F.lit(0)))
        return F.struct(
            F.when(s["start"] >= reach, F.concat(done["parts"], F.array(gap, mark(s)))).otherwise(done["parts"]).alias("parts"),
            F.greatest(reach, s["end"]).alias("reach"),
        )

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).alias("reach"))
    whole = F.aggregate(spans, start, step, lambda d: F.concat(F.array_join(d["parts"], ""), F.substr(text, d["reach"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)
