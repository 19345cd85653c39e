"""Cleaning: timestamps from text, required fields, date texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafeed.functions import quality
from stratafeed.functions import text as texts

from .registry import check, table


def iso_text(column: str, digits: int | None = None) -> Column:
    """ISO text of a zone-free timestamp, optionally cut after ``digits`` characters."""
    text = F.replace(F.col(column).cast("string"), F.lit(" "), F.lit("T"))
    return text if digits is None else F.substring(text, 1, digits)


@check("SELECT event_id, date_trunc('second', ts) AS ts FROM events")
def normalise_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return texts.normalise_iso(
        events.select("event_id", iso_text("ts", 19).alias("ts")), ["ts"]
    )


@check("""
    SELECT event_id, ts AS full_ts,
           CASE WHEN ts = date_trunc('second', ts) THEN ts END AS strict_ts
    FROM events
""")
def normalise_iso_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with a fraction: null, or kept to the microsecond."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", iso_text("ts").alias("strict_ts"), iso_text("ts").alias("full_ts")
    )
    strict = texts.normalise_iso(rows, ["strict_ts"])
    return texts.normalise_iso(strict, ["full_ts"], keep_fraction=True)


@check("""
    SELECT event_id,
           CASE WHEN event_type IN ('click', 'view') THEN date_trunc('second', ts)
           END AS ts
    FROM events
""")
def normalise_iso_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no timestamps give null instead of an error."""
    good = iso_text("ts", 19)
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", F.lit(""))
        .when(kind == "purchase", F.substring(good, 1, 10))
        .when(kind == "signup", F.concat(F.lit("2024-02-30T"), F.substring(good, 12, 8)))
        .otherwise(good)
        .alias("ts"),
    )
    return texts.normalise_iso(rows, ["ts"])


@check("""
    SELECT event_type <> 'error' AS is_valid, count(*) AS n_rows
    FROM events GROUP BY 1
""")
def required_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = quality.mark_valid(_with_missing(spark, sf_dir), ["event_type", "ts"])
    return marked.groupBy("is_valid").agg(F.count("*").alias("n_rows"))


@check("""
    SELECT event_id, user_id, 'good' AS part FROM events WHERE event_type <> 'error'
    UNION ALL
    SELECT event_id, user_id, 'rejected' FROM events WHERE event_type = 'error'
""")
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejected = quality.split_valid(
        _with_missing(spark, sf_dir), ["event_type", "ts"]
    )
    columns = ["event_id", "user_id"]
    return good.select(*columns, F.lit("good").alias("part")).unionAll(
        rejected.select(*columns, F.lit("rejected").alias("part"))
    )


@check("SELECT user_id, event_id, value FROM events")
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared fields are dropped, declared ones come in declared order."""
    declared = ["user_id", "event_id", "value"]
    events = table(spark, sf_dir, "events")
    return quality.conform(events, T.StructType([events.schema[c] for c in declared]))


@check("""
    SELECT event_id, try_strptime(
        '2024-' || lpad(json_extract_string(props, '$.k'), 2, '0') || '-01', '%Y-%m-%d'
    ) IS NOT NULL AS is_date
    FROM events
""")
def valid_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.lpad(F.get_json_object("props", "$.k"), 2, "0")
    text = F.concat(F.lit("2024-"), month, F.lit("-01"))
    return table(spark, sf_dir, "events").select(
        "event_id", texts.valid_date_text(text).alias("is_date")
    )


def _with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = F.nullif("event_type", F.lit("error"))
    return table(spark, sf_dir, "events").withColumn("event_type", missing)
