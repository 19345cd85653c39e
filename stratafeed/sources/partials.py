"""Partial statistics on disk, in folders by the hash of their part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.increments import (
    BUCKET,
    ROWS,
    Measures,
    in_bucket,
    keys_with_rows,
    of_parts,
    partials_of,
    replaced,
)
from .files import overwrite_partitions
from .storage import exists, files_in, is_complete, move_files

_PIECES = "__pieces"
#: Files of a folder that are left as they are, however small.
_MOST_FILES = 64


def refresh_partials(
    spark: SparkSession,
    path: str,
    work: str,
    current: DataFrame,
    changed: DataFrame,
    measures: Measures,
    buckets: int,
    rows_per_file: int = 200_000,
) -> tuple[DataFrame, DataFrame] | None:
    """Replace the partial rows of the parts in ``changed``; ``current`` has all rows.

    Gives all partial rows and the keys whose statistics may differ, or None if nothing
    changed. Only folders of changed parts are read. Where none of these had rows, the new
    files are moved beside the ones there; any other folder is replaced as a whole, in tasks
    and files of about ``rows_per_file``, and so is one that many small files have come to.
    Numbers of folders and of their rows, ``buckets`` at most, come to the driver;
    ``buckets`` stays the same for a path.

    ``work`` is a folder for this change alone. It holds the keys before anything is
    replaced, so that a call that is repeated after it stopped half way gives them all,
    those included that the changed parts no longer have. Files that it had moved are rows
    of changed parts then, and their folder is replaced. The caller removes ``work`` once
    the statistics are stored.
    """
    part = measures.part
    parts = changed.select(part).distinct().withColumn(BUCKET, in_bucket(part, buckets))
    parts = _stored(parts, f"{work}/parts")
    numbers = sorted(r[0] for r in parts.select(BUCKET).distinct().collect())
    if not numbers:
        return None
    fresh = partials_of(current, parts, measures)
    fresh = fresh.withColumn(BUCKET, in_bucket(part, buckets))
    fresh = _stored(fresh, f"{work}/fresh", BUCKET, rows_per_file)
    old, rewritten = fresh.where(F.lit(False)), set()
    keys, before = keys_with_rows(fresh, measures), f"{work}/keys"
    if exists(spark, path):
        old = spark.read.schema(fresh.schema).parquet(path).where(F.col(BUCKET).isin(numbers))
        # A row or two for each key and folder, by which both are told.
        has_rows = (F.col(ROWS) > 0).cast("int").alias(ROWS)
        held = of_parts(old, parts, part).select(*measures.keys, has_rows, BUCKET).distinct()
        held = _stored(held, f"{work}/held")
        rewritten = {r[0] for r in held.select(BUCKET).distinct().collect()}
        keys = keys.unionByName(keys_with_rows(held, measures))
    keys = keys.distinct()
    if is_complete(spark, before):
        keys = keys.unionByName(spark.read.schema(keys.schema).parquet(before)).distinct()
        keys = _stored(keys, f"{work}/keys_again")
    else:
        keys = _stored(keys, before)
    stored = _rows_by_bucket(old)
    for number in numbers:
        found = files_in(spark, _bucket(path, number))
        # Many files that are far smaller than they may be.
        if found > _MOST_FILES and stored.get(number, 0) < found * rows_per_file / 8:
            rewritten.add(number)
    if rewritten:
        own = F.col(BUCKET).isin(sorted(rewritten))
        # More rows than a folder gets.
        added = _rows_by_bucket(fresh)
        most = max(stored.get(n, 0) + added.get(n, 0) for n in rewritten)
        pieces = max(1, -(-most // rows_per_file))
        kept = replaced(old.where(own), fresh.where(own), parts.where(own), part)
        kept = kept.withColumn(_PIECES, F.lit(pieces))
        overwrite_partitions(kept, path, BUCKET, "parquet", _PIECES, len(rewritten) * pieces)
    for number in numbers:
        if number not in rewritten:
            move_files(spark, _bucket(f"{work}/fresh", number), _bucket(path, number))
    return spark.read.schema(fresh.schema).parquet(path), keys


def _rows_by_bucket(rows: DataFrame) -> dict[int, int]:
    """Numbers of rows, counted by the footers of files."""
    return {r[BUCKET]: r["count"] for r in rows.groupBy(BUCKET).count().collect()}


def _bucket(path: str, number: int) -> str:
    return f"{path}/{BUCKET}={number}"


def _stored(
    df: DataFrame, folder: str, by: str | None = None, rows_per_file: int = 0
) -> DataFrame:
    """``df`` computed once, into a folder of its own."""
    write = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    (write if by is None else write.partitionBy(by)).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
