"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    version: str | None,
    tie_break: Sequence[str] | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """One row per key: the one with the highest ``version``, null versions last.

    ``where`` is applied before ranking, so a newer row that fails it does not
    hide an older row that passes. Equal versions are decided by ``tie_break``,
    highest first; by default every remaining sortable column takes part, so that
    a recomputed task picks the same row again.

    The ``row_number() = 1`` shape lets Spark keep one row per key in each map
    task before the shuffle, so a hot key sends at most one row per map task.
    """
    if where is not None:
        df = df.where(where)
    if tie_break is None:
        tie_break = [
            f.name
            for f in df.schema
            if f.name != version and f.name not in keys and _sortable(f.dataType)
        ]
    order = ([] if version is None else [version]) + list(tie_break)
    ranked = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (
        df.withColumn(_RANK, F.row_number().over(ranked))
        .where(F.col(_RANK) == 1)
        .drop(_RANK)
    )


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype)
    return not isinstance(dtype, (T.MapType, T.VariantType))
