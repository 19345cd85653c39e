"""The steps of the match feed over orders and their lines, from landing to silver.

Orders stand for matches, lines for maps with one player each. Matches come in two
increments, all payloads with the first one, so that the later half of them waits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.plans import layers
from stratafeed.schemas import ENTRY_SCHEMA, MATCH_SCHEMA, PLAYERS, TEAMS
from stratafeed.sources import files, keyed
from stratafeed.sources.storage import new_folder, session_setting

from .registry import check, table

# Day ranges that together hold every order.
INCREMENTS = [("1900-01-01", "1997-12-31"), ("1998-01-01", "2100-01-01")]
ISO = "yyyy-MM-dd'T'HH:mm:ss"

LINES = """
    SELECT l.*, o.o_orderpriority, o.o_orderstatus
    FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
    WHERE o.o_orderstatus <> 'P'
"""


@check(f"""
    SELECT l_suppkey::INTEGER AS "PlayerId", 'p' || l_suppkey AS "MatchName",
           count(DISTINCT l_orderkey) AS "qtGames", min(l_shipdate) AS "firstMatch",
           max(l_shipdate) AS "lastMatch", avg(l_quantity) AS "avgKills"
    FROM (SELECT *, row_number() OVER (
              PARTITION BY l_suppkey, l_orderkey, l_returnflag
              ORDER BY l_shipdate DESC, l_quantity DESC) AS rn
          FROM ({LINES}))
    WHERE rn = 1 GROUP BY l_suppkey
""")
def pipeline_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver player statistics."""
    lake = _refreshed(spark, sf_dir, "pipeline_players")
    rows = keyed.read_current(spark, lake.silver(PLAYERS), PLAYERS)
    return rows.select(
        "PlayerId", "MatchName", "qtGames", "firstMatch", "lastMatch", "avgKills"
    )


@check(f"""
    SELECT "TeamName", l_returnflag AS "MapName", count(*) AS "matchCount" FROM (
        SELECT unnest([o_orderpriority, o_orderstatus]) AS "TeamName", l_returnflag
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY l_linenumber, l_orderkey
                  ORDER BY l_quantity DESC, l_returnflag DESC) AS rn
              FROM ({LINES}))
        WHERE rn = 1)
    GROUP BY "TeamName", l_returnflag
""")
def pipeline_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver counts of both teams."""
    lake = _refreshed(spark, sf_dir, "pipeline_teams")
    return keyed.read_current(spark, lake.silver(TEAMS), TEAMS)


@check(f"""
    SELECT DISTINCT l_orderkey::INTEGER AS "gameId", true AS stored FROM ({LINES})
""")
def pipeline_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed ids, each once, with a file."""
    lake = _refreshed(spark, sf_dir, "pipeline_manifest", silver=False)
    manifest = layers.landed_manifest(spark, lake)
    return manifest.select("gameId", F.col("path").endswith(".parquet").alias("stored"))


def _refreshed(
    spark: SparkSession, sf_dir: str, name: str, silver: bool = True
) -> layers.Lake:
    root = new_folder(spark, name)
    lake, inbox = layers.Lake(f"{root}/lake"), f"{root}/inbox"
    # A week of orders stands for a day of matches, of which the feed has some dozens.
    weekly = F.date_trunc("week", "o_orderdate")
    files.append_json(match_rows(spark, sf_dir, weekly), f"{root}/landing")
    # Lines are sorted by order once, for the lists and for the join; lists that are made by
    # hash are sorted before and after, as a task takes but 128 keys at a time.
    with session_setting(spark, "spark.sql.execution.useObjectHashAggregateExec", "false"):
        files.write_documents(_payloads(spark, sf_dir), inbox)
    landing = files.read_json(spark, f"{root}/landing", MATCH_SCHEMA)
    # The landing of the last increment is run a second time, which must change nothing.
    again = [] if silver else [INCREMENTS[-1]]
    for d1, d2 in [*INCREMENTS, *again]:
        layers.load_matches(spark, lake, landing, "range", d1=d1, d2=d2)
        layers.refresh_matches(spark, lake)
        layers.land_details(spark, lake, inbox, one_per_file=False)
        if silver:
            layers.explode_details(spark, lake)
            layers.refresh_details(spark, lake)
            layers.refresh_silver(spark, lake)
    return lake


def match_rows(
    spark: SparkSession, sf_dir: str, of_feed: Column | None = None
) -> DataFrame:
    """Orders as matches, by default under the day of their date."""
    day = F.date_format("o_orderdate", ISO)
    feed_day = day if of_feed is None else F.date_format(of_feed, ISO)
    one = F.lit(1)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("GameId"),
        one.alias("RoundId"),
        F.year("o_orderdate").alias("Season"),
        one.alias("SeasonType"),
        feed_day.alias("Day"),
        day.alias("DateTime"),
        day.alias("UpdatedUtc"),
        (F.col("o_orderstatus") != "P").alias("IsClosed"),
    )


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only what a line has of its own is shuffled; maps are made of it afterwards.
    line = F.struct(
        "l_linenumber",
        "l_returnflag",
        "l_quantity",
        "l_suppkey",
        "l_orderkey",
        F.date_format("l_shipdate", ISO).alias("shipped"),
    )
    # An order has few lines, so they are brought together before they are listed.
    lines = (
        table(spark, sf_dir, "lineitem")
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.collect_list(line).alias("lines"))
    )
    game = F.struct(
        F.col("o_orderkey").cast("int").alias("GameId"),
        F.col("o_orderpriority").alias("TeamAName"),
        F.col("o_orderstatus").alias("TeamBName"),
    )
    orders = table(spark, sf_dir, "orders").hint("merge")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        game.alias("Game"), F.transform("lines", _map_of).alias("Maps")
    )


def _map_of(line: Column) -> Column:
    """The map that stands for a line, with its one player."""
    given = {
        "PlayerId": line["l_suppkey"],
        "TeamId": F.lit(1),
        "Name": F.lit("player"),
        "MatchName": F.concat(F.lit("p"), line["l_suppkey"]),
        "Team": F.lit("x"),
        "IsClosed": F.lit(True),
        "GameId": line["l_orderkey"],
        "OpponentId": F.lit(2),
        "Opponent": F.lit("y"),
        "DateTime": line["shipped"],
        "UpdatedUtc": line["shipped"],
        "Kills": line["l_quantity"],
    }
    entry = F.struct(
        *[
            given[f.name].cast(f.dataType).alias(f.name)
            for f in ENTRY_SCHEMA
            if f.name in given
        ]
    )
    return F.struct(
        line["l_linenumber"].alias("Number"),
        line["l_returnflag"].alias("Name"),
        line["l_quantity"].cast("int").alias("CurrentRound"),
        F.array(entry).alias("Leaderboards"),
    )
