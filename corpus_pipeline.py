"""From raw documents to the pieces of a training mix, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet to the shared folder and hands it to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.llm import mixing, overlap, passages, pieces, rules
from stratafeed.llm._text import n_words
from stratafeed.llm.graph import stored
from stratafeed.llm.queries import (
    LEAST_QUALITY,
    PIECE_MODEL,
    quality_model,
    symbol_free,
    table,
)

#: The result of learned models: no SQL expresses it.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the attention classifier scores below the threshold.

    A null text is scored as an empty one. Without labels everything is kept.
    """
    model = quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    scored = passages.with_score(docs, "text", model, "__score")
    return scored.where(F.col("__score") >= LEAST_QUALITY).drop("__score")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the fixed rules or the learned list reject.

    Null and empty texts are too short and go.
    """
    learned = rules.learn(
        table(spark, sf_dir, "documents"),
        table(spark, sf_dir, "labels"),
        "doc_id",
        "text",
        "quality",
    )
    counted = rules.with_counts(docs, "text", "__counts")
    return counted.where(rules.kept(learned, "__counts")).drop("__counts")


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    Null ids come last; of rows with one id the smallest hash of the text decides; rows
    equal in both are one. Texts without a word have no duplicates.
    """
    identity = F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", F.xxhash64("text").alias("text")
    )
    keyed = docs.withColumn("__key", identity)
    grouped = overlap.join(keyed, "__key", "text").documents
    first = grouped.where(F.col("__key") == F.col("component_id")).select("__key")
    kept = keyed.join(first, "__key", "left_semi").dropDuplicates(["__key"])
    return kept.select(*docs.columns)


def weighted_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, so that sources meet their targets."""
    sized = docs.withColumns(
        {
            "__size": n_words(F.col("text")),
            "__quality": symbol_free(F.col("text")),
            "__tie": F.xxhash64("text"),
        }
    )
    mixed = mixing.mix(sized, "doc_id", "source", "__size", "__quality", ties=["__tie"])
    return mixing.repeat(mixed).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's pieces."""
    encoded = pieces.encode(docs.select("doc_id", "source", "text"), "text", pieces.load(PIECE_MODEL))
    return encoded.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", one_per_group),
    ("mixing", weighted_mix),
    ("pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
