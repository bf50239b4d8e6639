"""Filter context over the star: filters on a table reach the tables related to it, as semi-joins on keys.

A :class:`Star` knows the marts and how they relate. ``sliced`` answers what is left of a table under
filters that name any tables: a filter on a dimension goes to its facts (and on, where the fact is
itself the other side of a relationship), a filter on a fact never goes back to its dimensions, unless
the relationship is one to one, which lets filters through in both directions. A row without a
dimension row is left only by context that does not touch that dimension.

Each semi-join reads the keys of the filtered side alone. Spark
broadcasts them by their measured size; beyond that both sides are shuffled by key, and for a large
fact Spark builds a Bloom filter of the keys that drops fact rows at the scan
(``spark.sql.optimizer.runtime.bloomFilter.*``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Context = Mapping[str, Column | str]


@dataclass(frozen=True)
class Relationship:
    """``one[key]`` -> ``many[on]``; ``both`` where it is one to one."""

    one: str
    key: str
    many: str
    on: str
    both: bool = False

    def arrows(self) -> list[tuple[str, str, str, str]]:
        """(from, its key, to, its key) in every direction that filters pass."""
        there = (self.one, self.key, self.many, self.on)
        return [there, (self.many, self.on, self.one, self.key)] if self.both else [there]


# The relationships of the report's data model.
RELATIONSHIPS = (
    Relationship("dim_date", "date_key", "fct_orders", "order_date"),
    Relationship("dim_date", "date_key", "kpi_daily", "date_key"),
    Relationship("dim_customers", "customer_id", "fct_orders", "customer_id"),
    Relationship("dim_customers", "customer_id", "fct_subscriptions", "customer_id"),
    Relationship("dim_customers", "customer_id", "customer_segments", "customer_id", both=True),
)


class Star:
    """Tables and their relationships; only tables that a question needs are looked up in ``tables``."""

    def __init__(self, tables: Mapping[str, DataFrame], relationships: Sequence[Relationship] = RELATIONSHIPS):
        self.tables = tables
        self.arrows = [a for r in relationships for a in r.arrows()]

    def _path(self, source: str, target: str) -> list[tuple[str, str, str, str]] | None:
        """The shortest way a filter takes from ``source`` to ``target``."""
        ways, seen = [[]], {source}
        while ways:
            following = []
            for way in ways:
                at = way[-1][2] if way else source
                if at == target:
                    return way
                for arrow in self.arrows:
                    if arrow[0] == at and arrow[2] not in seen:
                        seen.add(arrow[2])
                        following.append([*way, arrow])
            ways = following
        return None

    def reaches(self, source: str, target: str) -> bool:
        return self._path(source, target) is not None

    def sliced(self, table: str, where: Context | None = None) -> DataFrame:
        """The rows of ``table`` left by all filters that reach it; others do not concern it."""
        for name in where or ():
            if name not in {t for a in self.arrows for t in (a[0], a[2])} and name not in self.tables:
                raise KeyError(f"no table {name!r} in the model")
        return self._kept(table, dict(where or {}))

    def _kept(self, table: str, where: dict[str, Column | str]) -> DataFrame:
        df = self.tables[table]
        if table in where:
            df = df.where(where[table])
        # Filters that come the same last step are one set of keys.
        steps: dict[tuple[str, str, str, str], dict[str, Column | str]] = {}
        for source, predicate in where.items():
            if source != table and (way := self._path(source, table)):
                steps.setdefault(way[-1], {})[source] = predicate
        for (source, key, _, on), reaching in steps.items():
            keys = self._keys(source, key, reaching)
            df = df.join(keys, F.col(on) == F.col("_key"), "left_semi")
        return df

    def _keys(self, table: str, key: str, where: dict[str, Column | str]) -> DataFrame:
        """The keys of ``table``, each once by its relationship, under ``where``; a table that only hands on keys is not read."""
        if len(where) == 1 and table not in where:
            (source,) = where
            *_, (before, its, _, on) = self._path(source, table)
            if on == key:
                # The keys of the table before, of which a semi-join keeps those that exist here;
                # facts refer to them by the same key, so nothing is gained by looking here too.
                return self._keys(before, its, where)
        kept = self._kept(table, where).where(F.col(key).isNotNull())
        return kept.select(F.col(key).alias("_key"))

    def grouped(self, table: str, columns: Sequence[str], where: Context | None = None) -> tuple[DataFrame, list[str]]:
        """``sliced`` rows with ``columns`` of its dimensions, and the names they have now.

        A column is given by name, if ``table`` has it, or as ``dimension.column``; rows without a
        dimension row have NULL there.
        """
        df, names = self.sliced(table, where), []
        wanted: dict[tuple[str, str, str, str], list[str]] = {}
        for column in columns:
            owner, _, name = column.rpartition(".")
            names.append(name)
            if owner in ("", table):
                if name not in df.columns:
                    raise KeyError(f"{table} has no column {name!r}; name its dimension")
                continue
            way = self._path(owner, table)
            if way is None or len(way) != 1:
                raise KeyError(f"{owner} is no dimension of {table}")
            wanted.setdefault(way[0], []).append(name)
        if len(set(names)) < len(names):
            raise ValueError(f"columns of one name: {list(columns)}")
        for (dimension, key, _, on), picked in wanted.items():
            side = self.tables[dimension].select(F.col(key).alias("_key"), *(F.col(c).alias(f"_of_{c}") for c in picked))
            df = df.join(side, F.col(on) == F.col("_key"), "left").drop("_key")
            for c in picked:
                df = df.withColumn(c, F.col(f"_of_{c}")).drop(f"_of_{c}")
        return df, names

    def aggregate(self, table: str, aggregates: Mapping[str, Column], by: Sequence[str] = (), where: Context | None = None) -> DataFrame:
        """Aggregates of the rows left, per combination of ``by``: what a visual shows of a table."""
        df, names = self.grouped(table, by, where)
        return df.groupBy(*names).agg(*(a.alias(n) for n, a in aggregates.items()))
