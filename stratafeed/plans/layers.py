"""The match feed, layer by layer.

Each function is one step and can be run again at any time: it takes what is new
since its last run. No step passes rows or ids through the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.backlog import pending, without_done
from ..operators.days import find_range, rows_between
from ..operators.increments import Measures, of_keys, totals
from ..operators.nested import ENTRY, MAP, flatten_details
from ..operators.stats import entity_stats, side_counts
from ..schemas import (
    LEADERBOARD_SCHEMA,
    LEADERBOARDS,
    MAP_SCHEMA,
    MAPS,
    MATCH_SCHEMA,
    MATCHES,
    PAYLOAD_SCHEMA,
    PLAYER_MEANS,
    PLAYERS,
    TEAMS,
    TableSpec,
)
from ..sources import catalog, files, keyed
from ..sources.partials import refresh_partials
from ..sources.storage import (
    exists,
    list_folders,
    remove_folder,
    replace_folder,
    session_setting,
)
from ..streaming.incremental import (
    bounded_splits,
    drain,
    finish,
    run_incremental,
    start,
    start_incremental,
)

_BATCH = T.StructField("batch", T.StringType())
#: Whether the match of a payload has not come yet.
_WAITS = "waits"
#: Payloads, and their ids, with the number of their folder, ``batch=<number>``.
_FOLDERS = T.StructType([*PAYLOAD_SCHEMA, _BATCH])
_IDS = T.StructType([T.StructField("GameId", T.IntegerType()), _BATCH])
#: Kind and schema of the raw rows of the tables that come from payloads.
_DETAILS = {LEADERBOARDS.name: (ENTRY, LEADERBOARD_SCHEMA), MAPS.name: (MAP, MAP_SCHEMA)}
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_PLAYER_MEASURES = Measures(
    PLAYERS.keys,
    "GameId",
    parts="qtGames",
    first={"firstMatch": "DateTime"},
    last={"lastMatch": "DateTime"},
    means=PLAYER_MEANS,
)
_TEAM_MEASURES = Measures(TEAMS.keys, "GameId", rows="matchCount")


@dataclass(frozen=True)
class Lake:
    """Folders of the layers below one root."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def bronze(self, spec: TableSpec) -> str:
        return f"{self.root}/bronze/{spec.name}"

    def silver(self, spec: TableSpec) -> str:
        return f"{self.root}/silver/{spec.name}"


def load_matches(
    spark: SparkSession,
    lake: Lake,
    landing: DataFrame,
    mode: str,
    today: dt.date | None = None,
    d1: str | None = None,
    d2: str | None = None,
) -> None:
    """Put the matches of the selected days into the raw feed, a folder for each day.

    A day that is loaded again is replaced, so a run may be repeated, whole or after it
    stopped half way. What is stored is told by the names of the folders; the feed is
    not read for it.
    """
    raw = lake.raw(MATCHES.name)
    stored = files.stored_days(spark, raw, "Day")
    # The range is found once, as two dates.
    found = find_range(landing, stored, mode, "Day", today or dt.date.today(), d1, d2)
    if found is not None:
        files.overwrite_days(rows_between(landing, "Day", *found), raw, "Day")


def refresh_matches(
    spark: SparkSession, lake: Lake, max_files: int | files.Intake | None = None, **options
) -> None:
    """Raw matches to the bronze match table.

    Lines that do not parse as declared are kept under ``malformed`` in its folder.
    """
    schema = files.with_corrupt(MATCH_SCHEMA)
    stream = files.stream_json(spark, lake.raw(MATCHES.name), schema, max_files)
    run_incremental(spark, stream, lake.bronze(MATCHES), MATCHES, **options)


def details_to_fetch(spark: SparkSession, lake: Lake) -> DataFrame:
    """Ids of bronze matches without a payload: what a collector has to deliver."""
    matches = keyed.read_current(spark, lake.bronze(MATCHES), MATCHES)
    return pending(matches, _landed_ids(spark, lake), ["GameId"])


def land_details(
    spark: SparkSession,
    lake: Lake,
    inbox: str,
    one_per_file: bool = True,
    max_files: int | files.Intake | None = None,
) -> None:
    """Store delivered payloads of bronze matches, each once.

    Each delivered file is read by one run only. Payloads whose match is not in
    bronze yet wait in a folder of their own until a later run finds the match; a
    waiting folder goes once all its ids have landed. Documents that do not parse as
    declared are kept with their file under ``payloads_rejected``, and their match
    stays pending.
    """
    matches = keyed.read_current(spark, lake.bronze(MATCHES), MATCHES)
    # Ids grow with the feed, and their files are far smaller than their rows.
    known = matches.select(F.col("GameId").alias("known_id")).hint("shuffle_hash")
    payloads, waiting = lake.raw("payloads"), lake.raw("payloads_waiting")
    ids = lake.raw("payload_ids")

    def landed(without: str | None = None) -> DataFrame | None:
        """Landed ids, without those of the folder that a repeated batch will replace."""
        stored = _landed_ids(spark, lake)
        if stored is None or without is None:
            return stored
        return stored.where(F.col("batch") != F.lit(without))

    def land(docs: DataFrame, own: str) -> None:
        fresh = files.select_landable(docs, landed(own), "Game.GameId", "GameId")
        fresh = fresh.select(*PAYLOAD_SCHEMA.names)
        fresh.write.mode("overwrite").parquet(f"{payloads}/batch={own}")
        record(own)

    def record(own: str) -> None:
        # The ids come last: without them the folder counts as not written.
        stored = files.read_parquet(spark, f"{payloads}/batch={own}", PAYLOAD_SCHEMA)
        of_batch = files.ids_of(stored, "Game.GameId", "GameId")
        of_batch.write.mode("overwrite").parquet(f"{ids}/batch={own}")

    def store(batch: DataFrame, number: int) -> None:
        own = str(number)
        # Broken documents are counted in the same pass, too.
        parsed, is_broken = Observation(), F.col(files.CORRUPT).isNotNull()
        seen_all = batch.observe(parsed, F.count_if(is_broken).alias("broken"))
        whole = seen_all.where(~is_broken).select(*PAYLOAD_SCHEMA.names)
        whole = files.by_id(whole, "Game.GameId", "GameId")
        docs = whole.join(known, F.col("GameId") == F.col("known_id"), "left")
        # Early payloads are written by the same job as the others, to a folder beside
        # theirs, so that documents are parsed and shuffled once.
        docs = docs.withColumn(_WAITS, F.col("known_id").isNull()).drop("known_id")
        fresh = files.select_landable(docs, landed(own), "Game.GameId", "GameId", waits=_WAITS)
        staged = f"{lake.raw('payloads_staged')}/batch={own}"
        fresh.drop("GameId").write.mode("overwrite").partitionBy(_WAITS).parquet(staged)
        replace_folder(spark, f"{payloads}/batch={own}", f"{staged}/{_WAITS}=false")
        if exists(spark, f"{staged}/{_WAITS}=true"):
            replace_folder(spark, f"{waiting}/batch={own}", f"{staged}/{_WAITS}=true")
        record(own)
        remove_folder(spark, staged)
        if parsed.get["broken"]:
            batch.where(is_broken).select("file", F.col(files.CORRUPT).alias("text")).write.mode(
                "overwrite"
            ).parquet(f"{lake.raw('payloads_rejected')}/batch={own}")

    _land_waiting(spark, lake, known, landed, land)
    schema = files.with_corrupt(PAYLOAD_SCHEMA)
    stream = files.stream_payloads(spark, inbox, schema, one_per_file, max_files)
    drain(
        stream.withColumn("file", F.col("_metadata.file_path")),
        store,
        lake.raw("payloads_checkpoint"),
    )


def _land_waiting(
    spark: SparkSession,
    lake: Lake,
    known: DataFrame,
    landed: Callable[[], DataFrame | None],
    land: Callable[[DataFrame, str], None],
) -> None:
    """Land the waiting payloads whose match has come; retire folders that are done.

    Ids decide; documents are read only if some can land. Only names of folders
    reach the driver.
    """
    path = lake.raw("payloads_waiting")
    names = list_folders(spark, path)
    if not names:
        return
    docs = files.read_parquet(spark, path, _FOLDERS)
    ids = docs.select("batch", F.col("Game.GameId").alias("GameId"))
    came = F.col("GameId") == F.col("known_id")
    ready = without_done(ids, landed(), ["GameId"]).join(known, came, "left_semi")
    ready = ready.select(F.col("GameId").alias("ready_id")).distinct().hint("shuffle_hash")
    if not ready.isEmpty():
        own = files.by_id(docs.drop("batch"), "Game.GameId", "GameId")
        chosen = own.join(ready, F.col("GameId") == F.col("ready_id"), "left_semi")
        # Counted by ids, so that a run that stopped in between is repeated by that name.
        number = len(list_folders(spark, lake.raw("payload_ids")))
        land(chosen, f"late-{number}")
    still = without_done(ids, landed(), ["GameId"]).select("batch").distinct()
    waits = {f"batch={row.batch}" for row in still.collect()}
    for name in names:
        if name not in waits:
            remove_folder(spark, f"{path}/{name}")


def landed_manifest(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every landed match with the file that holds its payload."""
    return files.read_parquet(spark, lake.raw("payloads"), _FOLDERS).select(
        F.col("Game.GameId").alias("gameId"), F.col("_metadata.file_path").alias("path")
    )


def _landed_ids(spark: SparkSession, lake: Lake) -> DataFrame | None:
    """``GameId`` and ``batch``, its folder, of all landed payloads.

    They are kept beside the payloads, so that payload files are not opened for them.
    """
    ids = files.read_if_present(spark, lake.raw("payload_ids"), _IDS)
    return None if ids is None else ids.hint("shuffle_hash")


def explode_details(
    spark: SparkSession, lake: Lake, max_files: int | files.Intake | None = None
) -> None:
    """Landed payloads to raw player and map rows, both in one pass over them.

    A checkpoint records which payload files are done, so a match without maps is
    not taken up again. Rows of both kinds are written by one job, to a folder for each.
    """
    payloads = files.stream_parquet(spark, lake.raw("payloads"), PAYLOAD_SCHEMA, max_files)

    def store(batch: DataFrame, number: int) -> None:
        folder = f"{lake.raw('details')}/batch={number}"
        rows = batch.write.mode("overwrite").option("parquet.block.size", files.ROW_GROUP_BYTES)
        # A task keeps a file of either kind open, in place of sorting its rows by kind.
        with session_setting(batch.sparkSession, _OPEN_FILES, str(len(_DETAILS))):
            rows.partitionBy("kind").parquet(folder)

    drain(flatten_details(payloads), store, lake.raw("details_checkpoint"))


def _stream_details(
    spark: SparkSession, lake: Lake, spec: TableSpec, max_files: int | files.Intake | None = None
) -> DataFrame:
    """Raw rows of one of the two tables that come from payloads."""
    kind, schema = _DETAILS[spec.name]
    rows = files.stream_parquet(
        spark,
        lake.raw("details"),
        T.StructType([T.StructField(kind, schema)]),
        max_files,
        name_glob=f"batch=*/kind={kind}",
    )
    return rows.select(f"{kind}.*")


def refresh_details(
    spark: SparkSession, lake: Lake, max_files: int | files.Intake | None = None, **options
) -> None:
    """Raw player and map rows to their bronze tables, two streams side by side."""
    timeout = options.pop("timeout", None)
    with bounded_splits(spark):
        queries = [
            start_incremental(
                spark,
                _stream_details(spark, lake, spec, max_files),
                lake.bronze(spec),
                spec,
                pool=spec.name,
                **options,
            )
            for spec in (LEADERBOARDS, MAPS)
        ]
        finish(queries, timeout)


def publish_bronze(spark: SparkSession, lake: Lake, database: str = "bronze") -> None:
    """Give the bronze tables names, for SQL."""
    catalog.ensure_database(spark, database)
    for spec in (MATCHES, LEADERBOARDS, MAPS):
        folder = keyed.compact(spark, lake.bronze(spec), spec)
        if folder is not None:
            catalog.publish_folder(spark, f"{database}.{spec.name}", folder)


def player_stats(leaderboards: DataFrame) -> DataFrame:
    """Games, first and last match and mean measures of each player."""
    return entity_stats(
        leaderboards,
        keys=["PlayerId", "MatchName"],
        distinct={"qtGames": "GameId"},
        first={"firstMatch": "DateTime"},
        last={"lastMatch": "DateTime"},
        means=PLAYER_MEANS,
    )


def team_counts(maps: DataFrame) -> DataFrame:
    """How many maps each team played, by map name."""
    return side_counts(
        maps,
        sides=["TeamAName", "TeamBName"],
        dims={"MapName": "Name"},
        side="TeamName",
        count="matchCount",
    )


def refresh_silver(
    spark: SparkSession,
    lake: Lake,
    database: str = "silver",
    buckets: int = 8,
    max_files: int | files.Intake | None = None,
) -> None:
    """Bring the statistics up to date with the raw rows that came since the last run.

    Only games with new rows are computed again, from their bronze rows, and only the
    statistics of players or teams that have or had a part in them are merged into the
    silver tables. Partial rows are kept beside those, in ``buckets`` folders by game, of
    which only the ones with changed games are read and replaced.
    """
    queries = []
    for spec, source, measures, rows in (
        (PLAYERS, LEADERBOARDS, _PLAYER_MEASURES, lambda df: df),
        (TEAMS, MAPS, _TEAM_MEASURES, _sides),
    ):
        store = partial(_store_stats, spark, lake, spec, source, measures, rows, buckets)
        queries.append(
            start(
                _stream_details(spark, lake, source, max_files).select("GameId"),
                store,
                f"{lake.silver(spec)}/_checkpoint",
                pool=spec.name,
            )
        )
    finish(queries)
    catalog.ensure_database(spark, database)
    for spec in (PLAYERS, TEAMS):
        folder = keyed.compact(spark, lake.silver(spec), spec)
        if folder is not None:
            catalog.publish_folder(spark, f"{database}.{spec.name}", folder)


def _store_stats(
    spark: SparkSession,
    lake: Lake,
    spec: TableSpec,
    source: TableSpec,
    measures: Measures,
    rows: Callable[[DataFrame], DataFrame],
    buckets: int,
    batch: DataFrame,
    number: int,
) -> None:
    """Statistics of what a batch has changed; the same if the batch is repeated."""
    path = lake.silver(spec)
    work = f"{path}/work-{number}"
    current = rows(keyed.read_current(spark, lake.bronze(source), source))
    touched = refresh_partials(
        spark, f"{path}/partials", work, current, batch, measures, buckets
    )
    if touched is not None:
        keyed.upsert_table(spark, path, spec, totals(of_keys(*touched, measures), measures))
    remove_folder(spark, work)


def _sides(maps: DataFrame) -> DataFrame:
    """A row for either team of each map."""
    return maps.select(
        F.explode(F.array("TeamAName", "TeamBName")).alias("TeamName"),
        F.col("Name").alias("MapName"),
        "GameId",
    )


def refresh_all(
    spark: SparkSession,
    lake: Lake,
    landing: DataFrame,
    inbox: str,
    mode: str,
    today: dt.date | None = None,
) -> None:
    """All steps in order."""
    load_matches(spark, lake, landing, mode, today)
    refresh_matches(spark, lake)
    land_details(spark, lake, inbox)
    explode_details(spark, lake)
    refresh_details(spark, lake)
    refresh_silver(spark, lake)
