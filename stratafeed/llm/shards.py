"""Sharding by jump consistent hashing.

A stable key and the number of shards decide the shard, without a table of ring
positions. With one more shard, about 1/(n+1) of the rows move, all of them into the
new one.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of unsigned 64-bit keys (Lamping and Veach, 2014)."""
    key = keys.astype(np.uint64)
    chosen = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        steps = (key[live] >> np.uint64(33)).astype(np.float64) + 1
        jump = ((chosen[live] + 1) * (float(1 << 31) / steps)).astype(np.int64)
        go = jump < shards
        live = live[go]
        chosen[live] = jump[go]
    return chosen


def shard_of(key: Column, shards: int) -> Column:
    """Shard of an integer key; a null key counts as -1."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf(T.IntegerType())
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(-1)))


def with_slots(
    df: DataFrame,
    shard: str,
    key: str,
    ties: Sequence[str] = (),
    slot: str = "slot",
    parts: int = 4096,
) -> DataFrame:
    """Number the rows of every shard from 0 without gaps.

    The rows of a shard are spread over ``parts`` hashed groups; the groups are counted,
    their counts are summed up (``parts`` rows per shard), and only a group is sorted.
    Order within a group is by key, then ``ties``; rows equal in all of these may take
    each other's number. ``parts`` bounds the counts; raise it with the rows.
    """
    group, before = "__group", "__before"
    rows = df.withColumn(group, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    upto = Window.partitionBy(shard).orderBy(group)
    begins = (
        rows.groupBy(shard, group)
        .agg(F.count("*").alias(before))
        .withColumn(before, F.sum(before).over(upto) - F.col(before))
    )
    inside = Window.partitionBy(shard, group).orderBy(key, *ties)
    return (
        rows.withColumn(slot, F.row_number().over(inside))
        .join(begins, [shard, group])
        .withColumn(slot, F.col(before) + F.col(slot) - 1)
        .drop(group, before)
    )


def place(df: DataFrame, key: str, shards: int, shard: str = "shard") -> DataFrame:
    """``df`` with the shard of each row. Nothing is shuffled.

    Rows with equal keys share a shard, null keys share one; an empty table stays
    empty; a column named like ``shard`` is replaced.
    """
    return df.withColumn(shard, shard_of(F.col(key), shards))


def write_shards(
    df: DataFrame, path: str, key: str, shards: int, files_per_shard: int = 1
) -> None:
    """Write one folder per shard, each in ``files_per_shard`` files."""
    placed = place(df, key, shards)
    spread = F.pmod(F.xxhash64(key), F.lit(files_per_shard))
    placed.repartition(shards * files_per_shard, "shard", spread).write.partitionBy(
        "shard"
    ).parquet(path)
