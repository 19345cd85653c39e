"""From nested documents to player and team statistics, through every layer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratafeed.operators import nested
from stratafeed.operators import stats as statistics
from stratafeed.schemas import TableSpec
from stratafeed.sources import files, keyed
from stratafeed.sources.storage import new_folder
from stratafeed.streaming import run_incremental

from .nested import ENTRIES, MAPS, documents
from .registry import check


@check(f"""
    SELECT "PlayerId", "MatchName", count(DISTINCT "GameId") AS "qtGames",
           min("DateTime")::TIMESTAMP AS "firstMatch",
           max("DateTime")::TIMESTAMP AS "lastMatch", avg("Kills") AS "avgKills"
    FROM (SELECT *, row_number() OVER (
              PARTITION BY "PlayerId", "GameId", "MapName"
              ORDER BY "DateTime" DESC, "MatchName" DESC, "Kills" DESC,
                       "Rating" DESC) AS rn
          FROM ({ENTRIES}))
    WHERE rn = 1 GROUP BY "PlayerId", "MatchName"
""")
def layered_player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to flat rows, to the keyed table, to statistics per player."""
    bronze = _to_bronze(
        spark,
        sf_dir,
        "layered_player_stats",
        nested.flatten_leaderboards,
        keys=("PlayerId", "GameId", "MapName"),
        version="DateTime",
        tie_break=("MatchName", "Kills", "Rating"),
        iso_columns=("DateTime",),
    )
    return statistics.entity_stats(
        bronze,
        keys=["PlayerId", "MatchName"],
        distinct={"qtGames": "GameId"},
        first={"firstMatch": "DateTime"},
        last={"lastMatch": "DateTime"},
        means={"avgKills": "Kills"},
    )


@check(f"""
    SELECT "TeamName", "MapName", count(*) AS "matchCount" FROM (
        SELECT unnest(["TeamAName", "TeamBName"]) AS "TeamName", "Name" AS "MapName"
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY "Number", "GameId"
                  ORDER BY "CurrentRound" DESC, "TeamAName" DESC,
                           "TeamBName" DESC) AS rn
              FROM ({MAPS}))
        WHERE rn = 1)
    GROUP BY "TeamName", "MapName"
""")
def layered_team_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the map rows, which have no version."""
    bronze = _to_bronze(
        spark,
        sf_dir,
        "layered_team_counts",
        nested.flatten_maps,
        keys=("Number", "GameId"),
        tie_break=("CurrentRound", "TeamAName", "TeamBName"),
    )
    return statistics.side_counts(
        bronze,
        sides=["TeamAName", "TeamBName"],
        dims={"MapName": "Name"},
        side="TeamName",
        count="matchCount",
    )


def _to_bronze(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    flatten: Callable[[DataFrame], DataFrame],
    **spec_fields,
) -> DataFrame:
    path = new_folder(spark, name)
    files.append_parquet(documents(spark, sf_dir), f"{path}/payloads")
    schema = documents(spark, sf_dir).schema
    rows = flatten(files.stream_parquet(spark, f"{path}/payloads", schema))
    spec = TableSpec(name, rows.schema, **spec_fields)
    run_incremental(spark, rows, f"{path}/table", spec)
    return keyed.read_current(spark, f"{path}/table", spec)
