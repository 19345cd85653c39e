"""Tables kept in buckets of their key, for upserts of large batches.

A batch beyond the broadcast threshold is shuffled once, into the buckets of the table,
and joined to them where they lie: the stored rows are not moved. The merged rows are
written to a second table with the same buckets, and a view by the name of the table is
then pointed at it, so that readers go from one state to the next in one step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import upsert

_SIDES = ("_a", "_b")


def save_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int
) -> None:
    """Write or replace the table ``name``, kept in ``buckets`` of its keys.

    For joins that leave it in place, ``buckets`` has to reach the session's
    ``spark.sql.shuffle.partitions``. Rows are not shuffled again if they are spread by
    the keys over as many tasks already.
    """
    spark = df.sparkSession
    side = next(s for s in _SIDES if s != _current_side(spark, name))
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name + side)
    )
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}{side}")


def merged_bucketed(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int,
    version: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """``upsert`` of ``source`` into the table ``name``, not yet written.

    ``source`` is used three times: store it first if it takes long to compute. Null keys
    match nothing, as in ``upsert`` by default: a null-safe comparison joins by
    other values than the ones that rows are kept by.
    """
    target = spark.table(name)
    spread = source.select(*target.columns).repartition(buckets, *keys)
    return upsert(target, spread, keys, version, unique=unique)


def upsert_bucketed(
    spark: SparkSession,
    name: str,
    source: DataFrame,
    keys: Sequence[str],
    buckets: int,
    version: str | None = None,
    unique: bool = False,
) -> None:
    """Merge ``source`` into the table ``name``; an absent table is an empty one.

    A call that is repeated after it stopped gives the same table: until the view moves,
    the earlier state is complete and untouched.
    """
    if spark.catalog.tableExists(name):
        merged = merged_bucketed(spark, name, source, keys, buckets, version, unique)
    else:
        merged = upsert(spark.createDataFrame([], source.schema), source, keys, version, unique=unique)
        merged = merged.repartition(buckets, *keys)
    save_bucketed(merged, name, keys, buckets)


def _current_side(spark: SparkSession, name: str) -> str | None:
    """Which of the two tables the view shows."""
    if not spark.catalog.tableExists(name):
        return None
    text = spark.sql(f"SHOW CREATE TABLE {name}").first()[0]
    return next(s for s in _SIDES if text.rstrip().endswith(s))
