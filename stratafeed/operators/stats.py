"""Keyed statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_stats(
    df: DataFrame,
    keys: Sequence[str],
    distinct: Mapping[str, str],
    first: Mapping[str, str],
    last: Mapping[str, str],
    means: Mapping[str, str],
) -> DataFrame:
    """Exact distinct counts, minima, maxima and null-skipping means per key.

    Each mapping is output name -> input column. Every distinct count is a branch
    of its own: it shuffles only the keys and its column, first by key and value,
    so that a hot key is spread over its values. The other aggregates shrink to
    one row per key and map task before they are shuffled. In one aggregate with
    the distinct count they would travel once per distinct value instead.
    """
    plain = [
        *[F.min(c).alias(n) for n, c in first.items()],
        *[F.max(c).alias(n) for n, c in last.items()],
        *[F.avg(c).alias(n) for n, c in means.items()],
    ]
    branches = [
        df.groupBy(*keys).agg(F.count_distinct(F.col(c)).alias(n))
        for n, c in distinct.items()
    ]
    if plain:
        branches.append(df.groupBy(*keys).agg(*plain))
    if len(branches) == 1:
        return branches[0]
    # One row per key and branch; null keys meet here like any other.
    together = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), branches
    )
    names = [*distinct, *first, *last, *means]
    return together.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])


def side_counts(
    df: DataFrame,
    sides: Sequence[str],
    dims: Mapping[str, str],
    side: str,
    count: str,
) -> DataFrame:
    """Appearances of each ``sides`` value per dimension, from whichever side.

    ``dims`` is output name -> input column. One scan: the sides become an array
    that is exploded, instead of one union branch per side. A null side forms a
    group of its own.
    """
    long = df.select(
        F.explode(F.array(*sides)).alias(side),
        *[F.col(c).alias(n) for n, c in dims.items()],
    )
    return long.groupBy(side, *dims).agg(F.count("*").alias(count))
