"""Tables and files as they are kept: by name, by key, one document per file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafeed.sources import bucketed, catalog, files
from stratafeed.sources.storage import new_folder

from .keyed import EARLY, KEYS, LATE, latest_events, latest_sql
from .registry import check, table

DATABASE = "checks_db"


def _name(spark: SparkSession, name: str) -> str:
    """A table name that no other run uses."""
    catalog.ensure_database(spark, DATABASE)
    return f"{DATABASE}.{name}_{uuid.uuid4().hex}"


@check("SELECT * FROM orders")
def saved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table that is written, then overwritten as a whole."""
    orders, name = table(spark, sf_dir, "orders"), _name(spark, "saved")
    catalog.save_table(orders.where("o_orderstatus <> 'F'"), name)
    catalog.save_table(orders, name)
    return spark.table(name)


@check("SELECT event_id, event_type, value FROM events")
def schema_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines read by a schema that a file holds."""
    events, path = table(spark, sf_dir, "events"), new_folder(spark, "schema_file")
    files.append_json(events, f"{path}/events")
    text = events.select("event_id", "event_type", "value").schema.json()
    lines = spark.range(1).select(F.lit(text).alias("value"))
    lines.write.text(f"{path}/schema")
    return files.read_json(spark, f"{path}/events", catalog.load_schema(f"{path}/schema"))


@check("""
    SELECT s_suppkey::INTEGER AS "GameId", s_name AS "TeamAName",
           s_nationkey AS "Number", s_acctbal AS "Balance"
    FROM supplier
""")
def payload_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each document, which spans many lines."""
    one_map = F.struct(F.col("s_nationkey").alias("Number"), F.col("s_acctbal").alias("Balance"))
    game = F.struct(
        F.col("s_suppkey").cast("int").alias("GameId"), F.col("s_name").alias("TeamAName")
    )
    docs = table(spark, sf_dir, "supplier").select(
        game.alias("Game"), F.array(one_map).alias("Maps")
    )
    path = new_folder(spark, "payload_documents")
    text = F.to_json(F.array(F.struct("Game", "Maps")), {"pretty": "true"})
    # One file a row is written by all tasks, each of which also puts its own in place.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        docs.select(text)
        .repartition(tasks)
        .write.option("maxRecordsPerFile", 1)
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .text(path)
    )
    read = files.read_payloads(spark, path, T.StructType(docs.schema.fields))
    return read.select("Game.*", F.explode("Maps").alias("m")).select(
        "GameId", "TeamAName", "m.Number", "m.Balance"
    )


@check(latest_sql())
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into a table in buckets of its key: older rows do not replace newer ones."""
    name = _name(spark, "bucketed")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = latest_events(spark, sf_dir, LATE)
    bucketed.save_bucketed(stored.repartition(buckets, *KEYS), name, KEYS, buckets)
    batch = latest_events(spark, sf_dir, EARLY)
    for _ in range(2):
        bucketed.upsert_bucketed(spark, name, batch, KEYS, buckets, version="ts", unique=True)
    return spark.table(name)
