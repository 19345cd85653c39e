"""Payloads of changing shape: orders as documents that gain and change fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafeed.operators import drift
from stratafeed.sources.storage import new_folder

from .registry import check, table

_TEAM = T.StructType().add("Name", "string").add("Rank", "integer")
_GAME = T.StructType().add("GameId", "long").add("Season", "integer").add("Team", _TEAM)
_MAP = T.StructType().add("Number", "integer").add("Score", "double")
DECLARED = T.StructType().add("Game", _GAME).add("Maps", T.ArrayType(_MAP))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line: seasons of finished orders are texts, open ones have a venue,
    urgent ones a flag on their map, low ones a team that is a name only; some are cut."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    key, year = F.col("o_orderkey"), F.year("o_orderdate")

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    season = F.when(status == "F", text('"s', year, '"')).otherwise(year.cast("string"))
    venue = F.when(status == "O", ', "Venue": {"City": "x", "Seats": 5}').otherwise("")
    team = F.when(priority == "5-LOW", '"alone"').otherwise(
        text('{"Name": "', F.col("o_custkey"), '", "Rank": null}')
    )
    flag = F.when(priority == "1-URGENT", ', "Over time": true').otherwise("")
    document = text(
        '{"Game": {"GameId": ', key, ', "Season": ', season, ', "Team": ', team, venue,
        '}, "Maps": [{"Number": 1, "Score": ', F.col("o_totalprice").cast("decimal(18,2)"), flag,
        '}, {"Number": 2}]}',
    )
    cut = F.when(key % 32 == 0, F.substring(document, F.lit(1), F.length(document) - 1))
    path = new_folder(spark, "drift")
    table(spark, sf_dir, "orders").select(F.coalesce(cut, document).alias("value")).write.text(path)
    return spark.read.text(path).select(drift.as_variant(F.col("value")).alias("document"))


_WHOLE = "(SELECT * FROM orders WHERE o_orderkey % 32 <> 0)"


@check(f"""
    SELECT o_orderkey AS "GameId",
           CASE WHEN o_orderstatus <> 'F' THEN year(o_orderdate)::INTEGER END AS "Season",
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey::VARCHAR END AS "Team",
           m.n::INTEGER AS "Number",
           CASE WHEN m.n = 1 THEN o_totalprice::DECIMAL(18, 2)::DOUBLE END AS "Score"
    FROM {_WHOLE}, (VALUES (1), (2)) AS m(n)
""")
def drifted_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared fields of documents, whatever else has changed in them."""
    whole = _documents(spark, sf_dir).where("document IS NOT NULL")
    docs = whole.select(drift.declared(F.col("document"), DECLARED).alias("d"))
    maps = docs.select("d.Game.*", F.explode("d.Maps").alias("m"))
    return maps.select("GameId", "Season", F.col("Team.Name").alias("Team"), "m.Number", "m.Score")


@check(f"""
    SELECT 'Game.Season' AS path, 'STRING' AS found, 'type' AS problem, count(*) AS n
    FROM {_WHOLE} WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'Game.Venue', 'OBJECT<City: STRING, Seats: BIGINT>', 'unknown', count(*)
    FROM {_WHOLE} WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT 'Game.Team', 'STRING', 'type', count(*) FROM {_WHOLE} WHERE o_orderpriority = '5-LOW'
    UNION ALL
    SELECT 'Maps[*].Over time', 'BOOLEAN', 'unknown', count(*)
    FROM {_WHOLE} WHERE o_orderpriority = '1-URGENT'
""")
def drifted_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the documents hold that the schema does not say."""
    return drift.drift(_documents(spark, sf_dir), "document", DECLARED)
