"""Keyed statistics that are kept up to date without reading everything again.

A table of partial statistics holds one row per key and part, such as player and game:
how many rows, and the sum, count, minimum or maximum of each measure. Statistics of a key
are merged from its parts. When rows of some parts come, change or go, the partial rows of
those parts are replaced by ones computed from their current rows. Nothing is subtracted,
so corrected minima and maxima and keys that a row no longer has are right as well, and a
repeated update changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Number of rows behind a partial row. A changed part without rows keeps one row with 0.
ROWS = "__rows"
BUCKET = "bucket"


@dataclass(frozen=True)
class Measures:
    """``parts`` and ``rows`` name the number of distinct parts and of rows, if wanted.

    ``first``, ``last`` and ``means`` are output name -> input column; a mean is a double
    over the values that are not null.
    """

    keys: tuple[str, ...]
    part: str
    parts: str | None = None
    rows: str | None = None
    first: Mapping[str, str] = field(default_factory=dict)
    last: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)

    def partial(self) -> list[Column]:
        """Aggregates of one partial row."""
        return [
            *[F.min(c).alias(n) for n, c in self.first.items()],
            *[F.max(c).alias(n) for n, c in self.last.items()],
            *[F.sum(F.col(c).cast("double")).alias(_sum(n)) for n, c in self.means.items()],
            *[F.count(c).alias(_count(n)) for n, c in self.means.items()],
        ]

    def merged(self) -> list[Column]:
        """Aggregates of a key's partial rows; its columns are in the order of the fields."""
        means = [F.try_divide(F.sum(_sum(n)), F.sum(_count(n))).alias(n) for n in self.means]
        return [
            *([F.count(self.part).alias(self.parts)] if self.parts else []),
            *([F.sum(ROWS).alias(self.rows)] if self.rows else []),
            *[F.min(n).alias(n) for n in self.first],
            *[F.max(n).alias(n) for n in self.last],
            *means,
        ]


def partials(rows: DataFrame, measures: Measures) -> DataFrame:
    """One row per key and part."""
    return rows.groupBy(*measures.keys, measures.part).agg(
        F.count("*").alias(ROWS), *measures.partial()
    )


def totals(stored: DataFrame, measures: Measures) -> DataFrame:
    """Statistics of every key; keys whose rows are all gone have none."""
    return stored.where(F.col(ROWS) > 0).groupBy(*measures.keys).agg(*measures.merged())


def partials_of(current: DataFrame, changed: DataFrame, measures: Measures) -> DataFrame:
    """Partial rows of the ``changed`` parts (distinct), from all ``current`` rows.

    A changed part that has no rows left gives one row with null keys and no rows. The null
    part has a branch of its own, as a join that matches nulls is dealt by other columns
    than the aggregate: this way rows are shuffled once, by their part.
    """
    part, wanted, here = measures.part, "__changed", "__here"
    asked = changed.select(F.col(part).alias(wanted))
    found = current.withColumn(here, F.lit(True))

    def computed(which: Callable[[Column], Column], same: Column) -> DataFrame:
        own = asked.where(which(F.col(wanted)))
        both = own.join(found.where(which(F.col(part))), same, "left")
        return (
            both.drop(part)
            .groupBy(*measures.keys, F.col(wanted).alias(part))
            .agg(F.count(here).alias(ROWS), *measures.partial())
        )

    given = computed(Column.isNotNull, F.col(wanted) == F.col(part))
    return given.unionByName(computed(Column.isNull, F.col(wanted).eqNullSafe(F.col(part))))


def replaced(stored: DataFrame, fresh: DataFrame, changed: DataFrame, part: str) -> DataFrame:
    """``stored`` with the rows of the ``changed`` parts replaced by ``fresh`` ones."""
    kept = _matching(stored, changed, [part], "left_anti")
    return kept.unionByName(fresh.select(*stored.columns))


def touched_keys(
    stored: DataFrame, fresh: DataFrame, changed: DataFrame, measures: Measures
) -> DataFrame:
    """Distinct keys whose statistics may differ: those that changed parts had or have."""
    had = of_parts(stored, changed, measures.part)
    return keys_with_rows(had, measures).unionByName(keys_with_rows(fresh, measures)).distinct()


def of_parts(stored: DataFrame, changed: DataFrame, part: str) -> DataFrame:
    """Partial rows of the ``changed`` parts."""
    return _matching(stored, changed, [part], "left_semi")


def keys_with_rows(stored: DataFrame, measures: Measures) -> DataFrame:
    """Keys that have statistics, as often as there are partial rows of theirs."""
    return stored.where(F.col(ROWS) > 0).select(*measures.keys)


def of_keys(stored: DataFrame, keys: DataFrame, measures: Measures) -> DataFrame:
    """Partial rows of some keys only; while the keys are few, nothing is shuffled."""
    return _matching(stored, keys, measures.keys, "left_semi")


def without_keys(stats: DataFrame, keys: DataFrame, measures: Measures) -> DataFrame:
    """Statistics of the other keys; null keys count as equal."""
    return _matching(stats, keys, measures.keys, "left_anti")


def in_bucket(part: str, buckets: int) -> Column:
    """The bucket of a part, by which partial rows are spread over folders."""
    return F.pmod(F.xxhash64(part), F.lit(buckets)).cast("int")


def _matching(rows: DataFrame, wanted: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    same = reduce(and_, (F.col(f"a.`{n}`").eqNullSafe(F.col(f"b.`{n}`")) for n in names))
    return rows.alias("a").join(wanted.select(*names).alias("b"), same, how)


def _sum(name: str) -> str:
    return f"{name}__sum"


def _count(name: str) -> str:
    return f"{name}__n"
