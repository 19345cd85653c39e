"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bits of the hash by which keys are counted before they are ranked.
_BIN_BITS = 12


def key_crc(key: Column) -> Column:
    """crc32 of a key's text; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def labelled_texts(
    docs: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    label: str,
    per_label: int,
    seed: int = 3,
) -> DataFrame:
    """``key``, ``text`` and ``label`` of at most ``per_label`` keys of each label.

    Keys are drawn by a hash of them, the same in every run. Where a key has several
    labels, the smallest holds; rows without key or label are not drawn. Of several texts
    with one key the one with the smallest hash counts, so the bound holds for rows too. At
    most ``per_label`` keys and labels per distinct label are broadcast, nothing else.
    """
    given = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(label).alias("label"))
    )
    # A count of bins of the hash tells how many keys of its label come before a bin, so
    # that a label is ranked bin by bin, and only as far as the sample reaches.
    hashed = given.withColumn("__hash", F.xxhash64("key", F.lit(seed)))
    hashed = hashed.withColumn("__bin", F.shiftright("__hash", 64 - _BIN_BITS))
    earlier = (
        Window.partitionBy("label").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    )
    bins = (
        hashed.groupBy("label", "__bin")
        .agg(F.count("*").alias("__keys"))
        .withColumn("__before", F.coalesce(F.sum("__keys").over(earlier), F.lit(0)))
        .where(F.col("__before") < per_label)
        .drop("__keys")
    )
    within = Window.partitionBy("label", "__bin").orderBy("__hash", "key")
    drawn = (
        hashed.join(bins, ["label", "__bin"])
        .withColumn("__rank", F.col("__before") + F.row_number().over(within))
        .where(F.col("__rank") <= per_label)
        .select("key", "label")
    )
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(drawn), "key")
    # Copies of a key shrink to one row in each task before they are shuffled.
    own = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("own")
    return found.groupBy("key", "label").agg(own).select(
        "key", F.col("own.text").alias("text"), "label"
    )
