"""Bounded streams into keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.schemas import TableSpec
from stratafeed.sources import files, keyed
from stratafeed.sources.storage import new_folder, size_of
from stratafeed.streaming import run_incremental

from .keyed import KEYS, latest_sql
from .registry import check, table

# Time slices that together hold every event, newest first.
SLICES = [
    "ts >= TIMESTAMP '2024-01-21'",
    "ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'",
    "ts < TIMESTAMP '2024-01-11'",
]


def _spec(events: DataFrame, version: str | None = "ts") -> TableSpec:
    ties = ("event_id",) if version else ("ts", "event_id")
    return TableSpec("events", events.schema, tuple(KEYS), version, ties)


@check(latest_sql("event_type <> 'error'"))
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet source, a gate column, one run, and a second run that sees nothing."""
    events = table(spark, sf_dir, "events")
    path = new_folder(spark, "stream_upsert")
    gated = events.withColumn("accepted", F.lit(True))
    spec = TableSpec(
        "events", gated.schema, tuple(KEYS), "ts", ("event_id",), gate="accepted"
    )
    for _ in range(2):
        stream = files.stream_parquet(
            spark, sf_dir, events.schema, name_glob="events.parque[t]"
        ).withColumn("accepted", F.col("event_type") != "error")
        run_incremental(spark, stream, path, spec)
    return keyed.read_current(spark, path, spec).drop("accepted")


@check("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'stored' WHEN 'F' THEN 'cut off'
                       ELSE 'other type' END AS outcome
    FROM orders
""")
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut off, or with a field of another type, are kept apart with their text."""
    key, status, price = columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    orders = table(spark, sf_dir, "orders").select(*columns)
    path = new_folder(spark, "malformed_lines")
    whole = F.to_json(F.struct(*columns))
    other = F.to_json(F.struct(key, status, F.lit("n/a").alias(price)))
    line = (
        F.when(F.col(status) == "F", F.substring(whole, F.lit(1), F.length(whole) - 1))
        .when(F.col(status) == "O", whole)
        .otherwise(other)
    )
    orders.select(line.alias("value")).write.text(f"{path}/raw")
    spec = TableSpec("orders", orders.schema, (key,))
    stream = files.stream_json(spark, f"{path}/raw", files.with_corrupt(orders.schema))
    run_incremental(spark, stream, f"{path}/table", spec)
    stored = keyed.read_current(spark, f"{path}/table", spec)
    apart = spark.read.schema("file string, text string").parquet(f"{path}/table/malformed")
    found = F.regexp_extract("text", r'"o_orderkey":(\d+)', 1).cast(orders.schema[key].dataType)
    return stored.select(key, F.lit("stored").alias("outcome")).unionByName(
        apart.select(
            found.alias(key),
            F.when(F.col("text").endswith("}"), "other type").otherwise("cut off").alias("outcome"),
        )
    )


@check(latest_sql())
def stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON source, over every file in its folder."""
    events = table(spark, sf_dir, "events")
    path = new_folder(spark, "stream_json")
    files.append_json(events, f"{path}/raw")
    stream = files.stream_json(spark, f"{path}/raw", events.schema)
    run_incremental(spark, stream, f"{path}/table", _spec(events))
    return keyed.read_current(spark, f"{path}/table", _spec(events))


@check(latest_sql())
def stream_upsert_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that arrive newest first, one run each: late rows do not win."""
    return _replay(spark, sf_dir, "stream_upsert_late", "ts", compact_share=0)


@check("""
    SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id, event_type
            ORDER BY ts < TIMESTAMP '2024-01-11' DESC,
                     ts < TIMESTAMP '2024-01-21' DESC, ts DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1
""")
def stream_last_batch_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same slices without a version: the last batch wins."""
    return _replay(spark, sf_dir, "stream_last_batch_wins", None, compact_share=float("inf"))


def _replay(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    version: str | None,
    compact_share: float,
) -> DataFrame:
    events = table(spark, sf_dir, "events")
    spec, path = _spec(events, version), new_folder(spark, name)
    for where in SLICES:
        files.append_parquet(events.where(where), f"{path}/raw")
        stream = files.stream_parquet(spark, f"{path}/raw", events.schema)
        run_incremental(spark, stream, f"{path}/table", spec, compact_share)
    return keyed.read_current(spark, f"{path}/table", spec)


@check(latest_sql())
def stream_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches bounded by bytes, over files that are moved away once read."""
    events = table(spark, sf_dir, "events")
    root = new_folder(spark, "stream_archived")
    spec = _spec(events)
    for condition in SLICES:
        files.append_json(events.where(condition).repartition(4, "event_id"), f"{root}/inbox")
        size = size_of(spark, f"{root}/inbox")
        intake = files.Intake(max_bytes=max(1, size // 4), archive=f"{root}/done")
        stream = files.stream_json(spark, f"{root}/inbox", events.schema, intake)
        run_incremental(spark, stream, f"{root}/table", spec)
    return keyed.read_current(spark, f"{root}/table", spec)
