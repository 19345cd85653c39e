"""The match feed from landing folders to silver tables, on hand-made rows."""

from __future__ import annotations

import datetime as dt
import json
import os
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratafeed.plans import layers, refresh_sql_table, run_sql_table
from stratafeed.plans.layers import Lake
from stratafeed.schemas import (
    LEADERBOARDS,
    MAPS,
    MATCH_SCHEMA,
    MATCHES,
    PLAYERS,
    TEAMS,
    TableSpec,
)
from stratafeed.sources import files, keyed
from stratafeed.sources.catalog import load_query
from stratafeed.streaming import run_incremental
from stratafeed.streaming.incremental import clean_batch

TODAY = dt.date(2023, 1, 10)


def match(game, day, updated, closed=True, **fields):
    row = {
        "GameId": game,
        "RoundId": 1,
        "Season": 2023,
        "SeasonType": 1,
        "Day": f"{day}T00:00:00",
        "DateTime": f"{day}T18:00:00",
        "UpdatedUtc": updated,
        "IsClosed": closed,
    }
    return row | fields


def entry(player, name, game, kills, updated="2023-01-10T20:00:00", **fields):
    row = {
        "PlayerId": player,
        "TeamId": 1,
        "Name": name,
        "MatchName": name,
        "Team": "x",
        "IsClosed": True,
        "GameId": game,
        "OpponentId": 2,
        "Opponent": "y",
        "DateTime": f"2023-01-{game:02}T18:00:00",
        "UpdatedUtc": updated,
        "Kills": kills,
    }
    return row | fields


def one_map(number, name, *entries, **fields):
    return {"Number": number, "Name": name, "Leaderboards": list(entries)} | fields


def payload(game, *maps, team_b="y"):
    return [
        {
            "Game": {"GameId": game, "TeamAName": "x", "TeamBName": team_b},
            "Maps": list(maps),
        }
    ]


class Feed:
    def __init__(self, spark, root):
        self.spark, self.lake = spark, Lake(f"{root}/lake")
        self.landing, self.inbox = f"{root}/landing", f"{root}/inbox"
        os.makedirs(self.landing)
        os.makedirs(self.inbox)
        self.files = 0

    def land(self, *matches):
        self.files += 1
        with open(f"{self.landing}/{self.files}.json", "w") as file:
            file.writelines(json.dumps(m) + "\n" for m in matches)

    def deliver(self, name, document):
        with open(f"{self.inbox}/{name}.json", "w") as file:
            json.dump(document, file)

    def run(self, mode="new", today=TODAY):
        landing = files.read_json(self.spark, self.landing, MATCH_SCHEMA)
        layers.refresh_all(self.spark, self.lake, landing, self.inbox, mode, today)

    def bronze(self, spec):
        return keyed.read_current(self.spark, self.lake.bronze(spec), spec)

    def silver(self, spec):
        return keyed.read_current(self.spark, self.lake.silver(spec), spec)


@pytest.fixture
def feed(spark, folder):
    return Feed(spark, folder)


def test_whole_feed(spark, feed):
    feed.land(
        match(10, "2023-01-10", "2023-01-10T20:00:00", TeamAScore=1),
        match(10, "2023-01-10", "2023-01-10T21:00:00", TeamAScore=2),
        match(10, "2023-01-10", "2023-01-10T22:00:00", closed=False, TeamAScore=9),
        match(9, "2023-01-09", "2023-01-09T20:00:00"),
    )
    feed.deliver(
        "10",
        payload(
            10,
            one_map(
                1,
                "dust",
                entry(1, "ann", 10, 20),
                entry(1, "ann", 10, 22, "2023-01-10T21:00:00"),
                entry(2, "bob", 10, None),
            ),
            one_map(2, "nuke", entry(1, "ann", 10, 10), Status=None),
            one_map(3, "inferno"),
        ),
    )
    feed.deliver("9", payload(9, one_map(1, "dust", entry(1, "ann", 9, 40)), team_b=None))
    feed.deliver("empty", [])

    # Nothing stored: only the newest day is loaded, so match 9 stays unknown.
    feed.run("new")
    assert [(r.GameId, r.TeamAScore) for r in feed.bronze(MATCHES).collect()] == [(10, 2)]
    assert feed.bronze(MATCHES).first().DateTime == dt.datetime(2023, 1, 10, 18)
    assert players(feed) == {(1, "ann"): (1, 16.0), (2, "bob"): (1, None)}
    assert teams(feed) == {
        (team, name): 1 for team in "xy" for name in ("dust", "nuke", "inferno")
    }

    # The older day comes with the history mode; the payload had been waiting.
    feed.run("history")
    assert {r.GameId for r in feed.bronze(MATCHES).collect()} == {9, 10}
    assert players(feed) == {(1, "ann"): (2, 24.0), (2, "bob"): (1, None)}
    assert teams(feed)[("x", "dust")] == 2
    assert teams(feed)[(None, "dust")] == 1

    # A run without news changes nothing.
    before = [state(feed, s) for s in (MATCHES, LEADERBOARDS, MAPS)]
    raw = spark.read.parquet(feed.lake.raw("payloads")).count()
    silver = players(feed), teams(feed)
    feed.run("new")
    assert [state(feed, s) for s in (MATCHES, LEADERBOARDS, MAPS)] == before
    assert spark.read.parquet(feed.lake.raw("payloads")).count() == raw == 2
    assert (players(feed), teams(feed)) == silver
    assert layers.details_to_fetch(spark, feed.lake).count() == 0
    manifest = layers.landed_manifest(spark, feed.lake).collect()
    assert sorted(r.gameId for r in manifest) == [9, 10]
    assert all("/raw/payloads/batch=" in r.path for r in manifest)

    # Tables by name, for SQL, and a player under a second name.
    layers.publish_bronze(spark, feed.lake, "feed_bronze")
    counted = spark.sql(
        "SELECT count(*) AS n FROM feed_bronze.tb_leaderboards AS l "
        "JOIN feed_bronze.tb_maps AS m ON l.GameId = m.GameId AND l.MapName = m.Name"
    )
    assert counted.first().n == 4
    with open(f"{feed.lake.root}/per_map.sql", "w") as file:
        file.write(
            "SELECT MapName, count(DISTINCT PlayerId) AS players\n"
            "FROM feed_bronze.tb_leaderboards GROUP BY MapName;\n"
        )
    per_map = run_sql_table(spark, load_query(f"{feed.lake.root}/per_map.sql"))
    spec = TableSpec("per_map", per_map.schema, ("MapName",))
    for _ in range(2):
        refresh_sql_table(spark, "feed_silver", feed.lake.silver(spec), spec, per_map)
    stored = spark.table("feed_silver.per_map").collect()
    assert {r.MapName: r.players for r in stored} == {"dust": 2, "nuke": 1}
    feed.land(match(11, "2023-01-11", "2023-01-11T20:00:00"))
    feed.deliver("11", payload(11, one_map(1, "dust", entry(1, "anna", 11, 5))))
    for _ in range(2):
        feed.run("new")
        assert players(feed) == {
            (1, "ann"): (2, 24.0),
            (1, "anna"): (1, 5.0),
            (2, "bob"): (1, None),
        }
    assert spark.table("silver.fs_players").count() == 3


def players(feed):
    return {
        (r.PlayerId, r.MatchName): (r.qtGames, r.avgKills)
        for r in feed.silver(PLAYERS).collect()
    }


def teams(feed):
    return {(r.TeamName, r.MapName): r.matchCount for r in feed.silver(TEAMS).collect()}


def state(feed, spec):
    return sorted(map(repr, feed.bronze(spec).collect()))


def test_new_version_of_a_match_and_a_late_one(spark, feed):
    raw = feed.lake.raw(MATCHES.name)

    def arrive(*matches):
        files.append_json(spark.createDataFrame(matches, MATCH_SCHEMA), raw)
        layers.refresh_matches(spark, feed.lake, compact_share=0)
        return {r.GameId: r.TeamAScore for r in feed.bronze(MATCHES).collect()}

    def version(score, updated, game=1):
        row = dict.fromkeys(MATCH_SCHEMA.names)
        return row | match(game, "2023-01-10", updated, TeamAScore=score)

    assert arrive(version(2, "2023-01-10T12:00:00")) == {1: 2}
    assert arrive(version(1, "2023-01-10T11:00:00")) == {1: 2}
    assert arrive(version(3, "2023-01-10T13:00:00"), version(7, None, 2)) == {1: 3, 2: 7}
    assert arrive(version(4, "2023-01-10T13:00:00")) == {1: 4, 2: 7}
    layers.refresh_matches(spark, feed.lake)
    assert feed.bronze(MATCHES).count() == 2


def test_rows_without_a_required_field_are_kept_apart(spark, feed):
    os.makedirs(feed.lake.raw(MATCHES.name))
    with open(f"{feed.lake.raw(MATCHES.name)}/m.json", "w") as file:
        for row in (
            match(1, "2023-01-10", "2023-01-10T12:00:00"),
            match(None, "2023-01-10", "2023-01-10T12:00:00"),
            match(2, "2023-01-10", "2023-01-10T12:00:00", Season=None),
            match(None, "2023-01-10", "2023-01-10T12:00:00", closed=False),
        ):
            file.write(json.dumps(row) + "\n")
    layers.refresh_matches(spark, feed.lake)
    assert [r.GameId for r in feed.bronze(MATCHES).collect()] == [1]
    rejected = spark.read.parquet(f"{feed.lake.bronze(MATCHES)}/rejected")
    assert rejected.count() == 2


def test_all_rows_rejected(spark, feed):
    os.makedirs(feed.lake.raw(MATCHES.name))
    with open(f"{feed.lake.raw(MATCHES.name)}/m.json", "w") as file:
        file.write(json.dumps(match(None, "2023-01-10", "2023-01-10T12:00:00")) + "\n")
    layers.refresh_matches(spark, feed.lake, timeout=120)
    assert feed.bronze(MATCHES).count() == 0


def test_maps_without_a_version(spark, feed):
    """Within a batch the highest round is kept; the last batch replaces it."""
    def arrive(name, *maps):
        feed.deliver(name, payload(1, *maps))
        docs = files.read_payloads(
            spark, f"{feed.inbox}/{name}.json", layers.PAYLOAD_SCHEMA
        )
        docs.write.parquet(f"{feed.lake.raw('payloads')}/{name}")
        layers.explode_details(spark, feed.lake)
        layers.refresh_details(spark, feed.lake)
        return [(r.Number, r.CurrentRound) for r in feed.bronze(MAPS).collect()]

    first = one_map(1, "dust", CurrentRound=30), one_map(1, "dust", CurrentRound=12)
    assert arrive("a", *first) == [(1, 30)]
    assert arrive("b", one_map(1, "dust", CurrentRound=5)) == [(1, 5)]


def test_a_lost_checkpoint_is_noticed(spark, feed):
    files.append_json(
        spark.createDataFrame(
            [dict.fromkeys(MATCH_SCHEMA.names) | match(1, "2023-01-10", "a")],
            MATCH_SCHEMA,
        ),
        feed.lake.raw(MATCHES.name),
    )
    layers.refresh_matches(spark, feed.lake)
    table = feed.lake.bronze(MATCHES)
    os.rename(f"{table}/_checkpoint", f"{table}/_gone")
    stream = files.stream_json(spark, feed.lake.raw(MATCHES.name), MATCH_SCHEMA)
    with pytest.raises(ValueError, match="checkpoint"):
        run_incremental(spark, stream, table, MATCHES)


def test_many_small_batches_compact_on_the_way(spark, feed):
    """One file per micro-batch; the base is renewed within the run."""
    raw = feed.lake.raw(MATCHES.name)
    blank = dict.fromkeys(MATCH_SCHEMA.names)
    for hour in (14, 12, 16, 10):
        rows = [
            blank | match(g, "2023-01-10", f"2023-01-10T{hour}:00:00", TeamAScore=hour)
            for g in (1, 2, hour)
        ]
        df = spark.createDataFrame(rows, MATCH_SCHEMA).coalesce(1)
        files.append_json(df, raw)
    layers.refresh_matches(spark, feed.lake, max_files=1, compact_share=0)
    table = feed.lake.bronze(MATCHES)
    assert keyed.open_increments(spark, table) == 0
    assert len([n for n in os.listdir(table) if n.startswith("base=")]) == 3
    assert {r.GameId: r.TeamAScore for r in feed.bronze(MATCHES).collect()} == {
        1: 16,
        2: 16,
        **{h: h for h in (10, 12, 14, 16)},
    }


@pytest.mark.parametrize("compact_share", [0, float("inf")])
def test_a_batch_that_is_repeated_after_a_failure(spark, feed, compact_share):
    """The last commit is taken back, so that its batch runs a second time."""
    raw, table = feed.lake.raw(MATCHES.name), feed.lake.bronze(MATCHES)
    blank = dict.fromkeys(MATCH_SCHEMA.names)
    for number, hour in enumerate((12, 13)):
        row = blank | match(1, "2023-01-10", f"2023-01-10T{hour}:00:00", TeamAScore=hour)
        files.append_json(spark.createDataFrame([row], MATCH_SCHEMA), raw)
        layers.refresh_matches(spark, feed.lake, compact_share=compact_share)
        before = state(feed, MATCHES)
        commits = f"{table}/_checkpoint/commits"
        os.rename(f"{commits}/{number}", f"{feed.lake.root}/undone-{number}")
        if os.path.exists(f"{commits}/.{number}.crc"):
            os.rename(f"{commits}/.{number}.crc", f"{feed.lake.root}/crc-{number}")
        layers.refresh_matches(spark, feed.lake, compact_share=compact_share)
        assert os.path.exists(f"{commits}/{number}")
        assert state(feed, MATCHES) == before
    assert feed.bronze(MATCHES).first().TeamAScore == 13


def test_repeated_landing_keeps_the_payloads(spark, feed):
    raw = feed.lake.raw(MATCHES.name)
    blank = dict.fromkeys(MATCH_SCHEMA.names)
    row = blank | match(1, "2023-01-10", "2023-01-10T12:00:00")
    files.append_json(spark.createDataFrame([row], MATCH_SCHEMA), raw)
    layers.refresh_matches(spark, feed.lake)
    feed.deliver("1", payload(1, one_map(1, "dust", entry(1, "ann", 1, 5))))
    feed.deliver("1-again", payload(1, one_map(1, "dust", entry(1, "ann", 1, 5))))
    layers.land_details(spark, feed.lake, feed.inbox)
    commits = feed.lake.raw("payloads_checkpoint") + "/commits"
    os.rename(f"{commits}/0", f"{feed.lake.root}/undone")
    os.rename(f"{commits}/.0.crc", f"{feed.lake.root}/crc")
    layers.land_details(spark, feed.lake, feed.inbox)
    assert spark.read.parquet(feed.lake.raw("payloads")).count() == 1


def test_an_old_file_that_arrives_late_is_read(spark, feed):
    """A copied file may keep a modification time from long ago."""
    raw = feed.lake.raw(MATCHES.name)
    os.makedirs(raw)
    for game, age in ((1, 0), (2, 400 * 86400)):
        path = f"{raw}/{game}.json"
        with open(path, "w") as file:
            file.write(json.dumps(match(game, "2023-01-10", "2023-01-10T12:00:00")))
        then = os.stat(path).st_mtime - age
        os.utime(path, (then, then))
        layers.refresh_matches(spark, feed.lake)
    assert {r.GameId for r in feed.bronze(MATCHES).collect()} == {1, 2}


def test_streamed_table_as_file_and_as_folder(spark, folder):
    from stratafeed.sources import files

    df = spark.range(40)
    df.coalesce(1).write.parquet(f"{folder}/one")
    part = next(Path(f"{folder}/one").glob("part-*.parquet"))
    (Path(folder) / "file").mkdir()
    shutil.copy(part, f"{folder}/file/t.parquet")
    df.repartition(4).write.parquet(f"{folder}/parts/t.parquet")
    for where in ("file", "parts"):
        stream = files.stream_parquet(spark, f"{folder}/{where}", df.schema, name_glob="t.parque[t]")
        query = (
            stream.writeStream.format("memory").queryName(f"seen_{where}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination(60)
        assert spark.table(f"seen_{where}").count() == 40


def test_versions_with_fractions_agree_in_one_and_two_batches(spark, folder):
    from pyspark.sql import types as T

    from stratafeed.schemas import TableSpec
    from stratafeed.sources import files, keyed
    from stratafeed.streaming.incremental import run_incremental

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("at", T.StringType())])
    spec = TableSpec("t", schema, ("k",), "at", iso_columns=("at",))
    told = [(1, "2023-01-01T00:00:00"), (1, "2023-01-02T00:00:00.5"), (1, "soon")]
    results = []
    for name, batches in (("one", [told]), ("three", [[told[1]], [told[0]], [told[2]]])):
        for batch in batches:
            files.append_json(spark.createDataFrame(batch, schema).coalesce(1), f"{folder}/{name}/raw")
            stream = files.stream_json(spark, f"{folder}/{name}/raw", schema)
            run_incremental(spark, stream, f"{folder}/{name}/table", spec)
        results.append([str(r["at"]) for r in keyed.read_current(spark, f"{folder}/{name}/table", spec).collect()])
    assert results[0] == results[1] == ["2023-01-02 00:00:00.500000"]


def bronze_match(spark, feed, *games):
    blank = dict.fromkeys(MATCH_SCHEMA.names)
    rows = [blank | match(g, "2023-01-10", "2023-01-10T12:00:00") for g in games]
    files.append_json(
        spark.createDataFrame(rows, MATCH_SCHEMA), feed.lake.raw(MATCHES.name)
    )
    layers.refresh_matches(spark, feed.lake)


def folders(feed, name):
    path = feed.lake.raw(name)
    return sorted(f for f in os.listdir(path) if "=" in f) if os.path.isdir(path) else []


def test_waiting_payloads_land_once_and_idle_runs_add_nothing(spark, feed):
    bronze_match(spark, feed, 1)
    for game in (1, 2, 3):
        feed.deliver(str(game), payload(game, one_map(1, "dust")))
    layers.land_details(spark, feed.lake, feed.inbox)
    assert folders(feed, "payloads") == ["batch=0"]
    assert folders(feed, "payloads_waiting") == ["batch=0"]
    for _ in range(3):
        layers.land_details(spark, feed.lake, feed.inbox)
    assert folders(feed, "payloads") == ["batch=0"]
    bronze_match(spark, feed, 2)
    for _ in range(2):
        layers.land_details(spark, feed.lake, feed.inbox)
    assert folders(feed, "payloads") == ["batch=0", "batch=late-1"]
    assert folders(feed, "payloads_waiting") == ["batch=0"]
    bronze_match(spark, feed, 3)
    layers.land_details(spark, feed.lake, feed.inbox)
    assert folders(feed, "payloads_waiting") == []
    landed = layers.landed_manifest(spark, feed.lake).collect()
    assert sorted(r.gameId for r in landed) == [1, 2, 3]


def test_payloads_that_do_not_parse_are_kept_and_stay_pending(spark, feed):
    bronze_match(spark, feed, 1, 2, 3)
    feed.deliver("1", payload(1, one_map(1, "dust")))
    feed.deliver("3", payload(3, one_map(1, "dust", TeamAScore="n/a")))
    Path(f"{feed.inbox}/2.json").write_text('[{"Game": {"GameId": 2, "Team')
    layers.land_details(spark, feed.lake, feed.inbox)
    rejected = spark.read.parquet(feed.lake.raw("payloads_rejected")).collect()
    assert sorted(r.file.rsplit("/", 1)[1] for r in rejected) == ["2.json", "3.json"]
    assert all(r.text for r in rejected)
    wanted = layers.details_to_fetch(spark, feed.lake).collect()
    assert sorted(r.GameId for r in wanted) == [2, 3]


def test_landing_compares_no_whole_documents(spark, feed):
    docs = spark.createDataFrame([], layers.PAYLOAD_SCHEMA)
    once = files.select_landable(docs, None, "Game.GameId", "GameId")
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "row_number" in line]
    assert ranked and not any("Maps" in line or "Game#" in line for line in ranked)


def test_match_lines_that_do_not_parse_are_kept_apart(spark, feed):
    """Cut off, or with a field of another type: neither merged nor lost."""
    raw = feed.lake.raw(MATCHES.name)
    os.makedirs(raw)
    good = json.dumps(match(1, "2023-01-10", "2023-01-10T20:00:00"))
    cut = json.dumps(match(2, "2023-01-10", "2023-01-10T20:00:00"))[:-9]
    typed = json.dumps(match(3, "2023-01-10", "2023-01-10T20:00:00", TeamAScore="n/a"))
    opened = json.dumps(match(4, "2023-01-10", "2023-01-10T20:00:00", closed=False))
    with open(f"{raw}/lines.json", "w") as file:
        file.write("\n".join([good, cut, typed, opened]))
    layers.refresh_matches(spark, feed.lake)
    assert [r.GameId for r in feed.bronze(MATCHES).collect()] == [1]
    apart = spark.read.parquet(f"{feed.lake.bronze(MATCHES)}/malformed").collect()
    assert sorted(r.text for r in apart) == sorted([cut, typed])
    assert all(r.file.endswith("lines.json") for r in apart)


def test_growing_ids_are_not_broadcast(spark, folder, monkeypatch):
    lake = layers.Lake(folder)
    files.append_parquet(
        spark.range(50).select(F.col("id").cast("int").alias("GameId")),
        f"{lake.raw('payload_ids')}/batch=0",
    )
    rows = spark.createDataFrame([match(g, "2023-01-01", "2023-01-02T00:00:00") for g in range(60)], MATCH_SCHEMA)
    for number in range(2):
        keyed.write_increment(clean_batch(rows, MATCHES), lake.bronze(MATCHES), number)
        if number == 0:
            keyed.compact(spark, lake.bronze(MATCHES), MATCHES)
    monkeypatch.setattr(keyed, "_MOST_BROADCAST", 0)
    current = keyed.read_current(spark, lake.bronze(MATCHES), MATCHES)
    docs = spark.range(60).select(F.struct(F.col("id").cast("int").alias("GameId")).alias("Game"))
    landed = layers._landed_ids(spark, lake)
    fresh = files.select_landable(docs, landed, "Game.GameId", "GameId")
    for df in (current, fresh, layers.details_to_fetch(spark, lake)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert current.count() == 60 and sorted(r.Game.GameId for r in fresh.collect()) == list(range(50, 60))


def test_documents_are_ranked_after_their_shuffle(spark):
    docs = spark.range(60).select(F.struct(F.col("id").cast("int").alias("GameId")).alias("Game"))
    landed = spark.range(50).select(F.col("id").cast("int").alias("GameId"))
    fresh = files.select_landable(docs.unionAll(docs), landed, "Game.GameId", "GameId")
    text = fresh._jdf.queryExecution().executedPlan().toString()
    # Printed from the last step to the first.
    assert text.rindex("WindowGroupLimit") < text.index("Exchange")
    assert sorted(r.Game.GameId for r in fresh.collect()) == list(range(50, 60))


def test_early_payloads_are_parsed_with_the_others(spark, feed, monkeypatch):
    from stratafeed.streaming.incremental import finish, start

    bronze_match(spark, feed, 1)
    for game in (1, 2, 3, 3):
        feed.deliver(f"{game}-{len(os.listdir(feed.inbox))}", payload(game, one_map(1, "dust")))
    read = []

    def watched(stream, store, checkpoint):
        query = start(stream, store, checkpoint)
        finish([query])
        read.extend(p["numInputRows"] for p in query.recentProgress)

    monkeypatch.setattr(layers, "drain", watched)
    layers.land_details(spark, feed.lake, feed.inbox)
    assert sum(read) == 4
    waiting = spark.read.parquet(feed.lake.raw("payloads_waiting"))
    assert sorted(r.Game.GameId for r in waiting.collect()) == [2, 3]
    assert [r.gameId for r in layers.landed_manifest(spark, feed.lake).collect()] == [1]
    assert folders(feed, "payloads_staged") == []
