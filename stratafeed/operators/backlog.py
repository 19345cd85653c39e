"""Work that has not been done yet, as anti-joins."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(
    work: DataFrame, done: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """Distinct keys of ``work`` that ``done`` does not hold.

    Null keys never match, so they stay pending. Both sides are made distinct
    first: the partial aggregate runs before the shuffle, which keeps a hot key
    from travelling more than once per map task, and the join then reuses the
    partitioning of the aggregate. ``done=None`` means nothing was done yet.
    """
    wanted = work.select(*keys).distinct()
    if done is None:
        return wanted
    return wanted.join(done.select(*keys).distinct(), list(keys), "left_anti")


def only_pending(
    rows: DataFrame, done: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """Whole rows of ``rows`` whose key ``done`` does not hold.

    Rows with a null in their key are pending whatever is done. They go round the join,
    so that they do not meet in one shuffle partition.
    """
    if done is None:
        return rows
    complete = reduce(and_, (F.col(k).isNotNull() for k in keys))
    fresh = without_done(rows.where(complete), done, keys)
    return fresh.unionByName(rows.where(~complete))


def without_done(
    rows: DataFrame, done: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """``only_pending`` for rows whose keys hold no null: one scan, one join."""
    if done is None:
        return rows
    return rows.join(
        done.select(*keys).distinct(), list(keys), "left_anti"
    ).select(*rows.columns)
