"""Required fields and declared-field projection."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has_required(required: Iterable[str]) -> Column:
    """True where every required column is present."""
    return reduce(and_, (F.col(c).isNotNull() for c in required), F.lit(True))


def mark_valid(
    df: DataFrame, required: Iterable[str], flag: str = "is_valid"
) -> DataFrame:
    """Add a boolean column saying whether all required columns are present."""
    return df.withColumn(flag, has_required(required))


def split_valid(
    df: DataFrame, required: Iterable[str]
) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``: together they are exactly the rows of ``df``."""
    ok = has_required(list(required))
    return df.where(ok), df.where(~ok)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Keep the declared fields, in declared order; drop everything else."""
    return df.select(*schema.names)
