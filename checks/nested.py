"""Nested payloads. Each line item becomes one document of the feed's shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.operators import nested
from stratafeed.sources import files
from stratafeed.sources.storage import new_folder

from .quality import iso_text
from .registry import check, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two maps per line item, with two players on the first and one on the second."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("shipped", iso_text("l_shipdate", 19)).select(
        F.struct(
            F.col("l_orderkey").alias("GameId"),
            F.col("l_returnflag").alias("TeamAName"),
            F.col("l_linestatus").alias("TeamBName"),
            F.lower("l_returnflag").alias("TeamAKey"),
            F.lower("l_linestatus").alias("TeamBKey"),
        ).alias("Game"),
        F.array(
            _map(1, "first", _entry("l_suppkey"), _entry("l_partkey")),
            _map(2, "second", _entry("l_suppkey")),
        ).alias("Maps"),
    )


def _map(number: int, name: str, *entries: Column) -> Column:
    return F.struct(
        (F.col("l_linenumber") * 10 + number).alias("Number"),
        F.lit(name).alias("Name"),
        F.nullif("l_linestatus", F.lit("O")).alias("Status"),
        F.col("l_quantity").cast("int").alias("CurrentRound"),
        F.array(*entries).alias("Leaderboards"),
    )


def _entry(player: str) -> Column:
    return F.struct(
        F.col(player).alias("PlayerId"),
        F.col("l_returnflag").alias("MatchName"),
        F.col("l_orderkey").alias("GameId"),
        F.col("shipped").alias("DateTime"),
        F.col("l_quantity").cast("float").alias("Kills"),
        F.col("l_extendedprice").alias("Rating"),
    )


ENTRIES = """
    SELECT p AS "PlayerId", l_returnflag AS "MatchName", l_orderkey AS "GameId",
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS "DateTime",
           l_quantity::FLOAT AS "Kills", l_extendedprice AS "Rating", m AS "MapName"
    FROM (SELECT *, l_suppkey AS p, 'first' AS m FROM lineitem
          UNION ALL SELECT *, l_partkey, 'first' FROM lineitem
          UNION ALL SELECT *, l_suppkey, 'second' FROM lineitem)
"""
MAPS = """
    SELECT (l_linenumber * 10 + n)::INTEGER AS "Number", m AS "Name",
           nullif(l_linestatus, 'O') AS "Status", l_quantity::INTEGER AS "CurrentRound",
           l_orderkey AS "GameId", l_returnflag AS "TeamAName",
           l_linestatus AS "TeamBName", lower(l_returnflag) AS "TeamAKey",
           lower(l_linestatus) AS "TeamBKey"
    FROM lineitem, (VALUES (1, 'first'), (2, 'second')) AS maps(n, m)
"""


@check(ENTRIES)
def flatten_leaderboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to player rows with the name of their map."""
    return nested.flatten_leaderboards(documents(spark, sf_dir))


@check(MAPS)
def flatten_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents to map rows with the attributes of their match."""
    return nested.flatten_maps(documents(spark, sf_dir))


@check("""
    SELECT l_orderkey, tag, position FROM (
        SELECT l_orderkey, l_returnflag AS tag, 0::INTEGER AS position
        FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL
        SELECT l_orderkey, l_linestatus, 1::INTEGER FROM lineitem
        WHERE l_linestatus = 'F'
    )
""")
def flatten_missing_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parents with an empty or a null array give no row."""
    lines = table(spark, sf_dir, "lineitem")
    tags = F.array(
        F.struct(F.col("l_returnflag").alias("tag"), F.lit(0).alias("position")),
        F.struct(F.col("l_linestatus").alias("tag"), F.lit(1).alias("position")),
    )
    children = (
        F.when(F.col("l_linestatus") == "F", tags)
        .when(F.col("l_returnflag") == "N", F.filter(tags, lambda t: F.lit(False)))
        .otherwise(F.lit(None))
    )
    return nested.explode_children(
        lines.select("l_orderkey", children.alias("tags")),
        "tags",
        {"l_orderkey": "l_orderkey"},
    )


@check(ENTRIES)
def payload_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON arrays, scanned back and flattened."""
    docs = documents(spark, sf_dir)
    path = new_folder(spark, "payload_files")
    files.write_documents(docs, path)
    scanned = files.read_payloads(spark, path, docs.schema, one_per_file=False)
    return nested.flatten_leaderboards(scanned)


@check("""
    SELECT DISTINCT o_orderkey AS "GameId", o_orderpriority AS "TeamAName"
    FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'F'
""")
def land_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents not landed before, without the empty ones, each id once.

    Low-priority orders stand for empty documents, finished ones for landed ids,
    and every document is delivered twice.
    """
    orders = table(spark, sf_dir, "orders")
    game = F.struct(
        F.col("o_orderkey").alias("GameId"), F.col("o_orderpriority").alias("TeamAName")
    )
    docs = orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", game).alias("Game")
    )
    finished = orders.where("o_orderstatus = 'F'").select(
        F.struct(F.col("o_orderkey").alias("GameId")).alias("Game")
    )
    landed = files.ids_of(finished, "Game.GameId", "GameId")
    fresh = files.select_landable(
        docs.unionAll(docs), landed, "Game.GameId", "GameId"
    )
    return fresh.select("Game.*")


