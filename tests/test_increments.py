"""Feeds by day, both details in one pass, streams side by side, statistics by increments."""

from __future__ import annotations

import datetime as dt
import json
import os
import threading
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratafeed.operators import days
from stratafeed.operators.increments import (
    Measures,
    of_keys,
    partials,
    partials_of,
    replaced,
    totals,
    touched_keys,
    without_keys,
)
from stratafeed.operators.nested import (
    flatten_details,
    flatten_leaderboards,
    flatten_maps,
)
from stratafeed.plans import layers
from stratafeed.schemas import MATCH_SCHEMA, PAYLOAD_SCHEMA, PLAYERS
from stratafeed.sources import files, keyed
from stratafeed.sources import partials as stored_partials
from stratafeed.sources.storage import session_setting
from stratafeed.streaming import finish, start

from test_layers import Feed, entry, match, one_map, payload, players


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def dated(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, day string")


def test_texts_that_are_no_days_never_bound_a_range(spark):
    rows = dated(spark, (1, "2023-01-09"), (2, "n/a"), (3, ""), (4, "0"), (5, None))
    assert tuple(days.frontier(rows, "day").first()) == (dt.date(2023, 1, 9),) * 2
    landing = dated(
        spark, *[(d, f"2023-01-{d:02}T10:00:00") for d in (8, 9, 10, 11, 12)], (0, "zzz")
    )
    new = days.select_rows(landing, rows, "new", "day", dt.date(2023, 1, 12))
    assert sorted(r.k for r in new.collect()) == [10, 11, 12]
    found = days.find_range(landing, rows, "new", "day", dt.date(2023, 1, 12))
    assert found == (dt.date(2023, 1, 10), dt.date(2023, 1, 14))
    gaps = days.calendar_gaps(dated(spark, (1, "2023-01-09"), (2, "x"), (3, "2023-01-12")), "day")
    assert sorted(str(r.day) for r in gaps.collect()) == ["2023-01-10", "2023-01-11"]
    none = dated(spark, (1, "x"))
    assert tuple(days.frontier(none, "day").first()) == (None, None)
    assert days.find_range(none, none, "history", "day", dt.date(2023, 1, 1)) is None


def test_the_landing_feed_is_read_once_for_a_range(spark, folder):
    rows = [(i, f"2023-01-{i:02}") for i in range(1, 21)]
    dated(spark, *rows).coalesce(1).write.json(f"{folder}/landing")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        read.add(1)
        yield from batches

    landing = spark.read.schema("k int, day string").json(f"{folder}/landing")
    counted = landing.mapInArrow(count, landing.schema)
    found = days.find_range(counted, None, "history", "day", dt.date(2023, 1, 15))
    assert found == (dt.date(2023, 1, 8), dt.date(2023, 1, 16))
    assert read.value == 1


def test_days_are_replaced_and_pruned(spark, folder):
    path = f"{folder}/feed"
    assert files.stored_days(spark, path, "day") is None
    first = dated(spark, (1, "2023-01-01"), (2, "2023-01-02T08:00:00"), (9, "soon"), (9, None))
    files.overwrite_days(first, path, "day")
    files.overwrite_days(first, path, "day")
    files.overwrite_days(dated(spark, (3, "2023-01-02"), (4, "2023-01-03")), path, "day")
    files.overwrite_days(dated(spark, (9, "soon")), path, "day")
    feed = files.read_days(spark, path, first.schema)
    assert sorted(r.k for r in feed.collect()) == [1, 3, 4]
    stored = files.stored_days(spark, path, "day").collect()
    assert sorted(str(r.day) for r in stored) == ["2023-01-01", "2023-01-02", "2023-01-03"]
    one = feed.where(F.col(files.DAY_FOLDER) == F.lit(dt.date(2023, 1, 2)))
    assert [r.k for r in one.collect()] == [3]
    text = plan(one)
    assert "PartitionFilters: [isnotnull(day_folder" in text
    assert text.count("FileScan json") == 1


def test_a_large_day_is_written_by_many_tasks(spark, folder):
    rows = spark.range(1000).select(
        F.col("id").cast("int").alias("k"),
        F.when(F.col("id") < 900, "2023-01-01").otherwise("2023-01-02").alias("day"),
    )
    files.overwrite_days(rows, folder + "/f", "day", "parquet", rows_per_file=100)
    written = {
        name: sum(f.endswith(".parquet") for f in os.listdir(f"{folder}/f/{name}"))
        for name in os.listdir(f"{folder}/f")
        if name.startswith(files.DAY_FOLDER)
    }
    assert written == {"day_folder=2023-01-01": 4, "day_folder=2023-01-02": 1}
    back = files.read_days(spark, f"{folder}/f", rows.schema, "parquet")
    assert back.columns == ["k", "day", files.DAY_FOLDER] and back.count() == 1000


def test_days_from_footers(spark, folder):
    days_of = spark.range(100).select(F.expr("date'2023-01-01' + cast(id as int)").alias("d"))
    days_of.repartition(3).write.parquet(f"{folder}/f")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert files.day_bounds(spark, f"{folder}/f", "d") == (dt.date(2023, 1, 1), dt.date(2023, 4, 10))
    assert "PushedAggregation: [MIN(d), MAX(d)]" in plan(files.footer_bounds(spark, f"{folder}/f", "d"))
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    days_of.where("false").write.parquet(f"{folder}/none")
    assert files.day_bounds(spark, f"{folder}/none", "d") == (None, None)
    days_of.select(F.col("d").cast("string").alias("d")).write.parquet(f"{folder}/text")
    with pytest.raises(ValueError):
        files.day_bounds(spark, f"{folder}/text", "d")


ODD_PAYLOADS = [
    payload(1, one_map(1, "dust", entry(1, "ann", 1, 2), entry(2, "bob", 1, None)), one_map(2, None))[0],
    {"Game": {"GameId": 2}, "Maps": None},
    {"Game": {"GameId": 3}, "Maps": []},
    {"Game": None, "Maps": [{"Number": 9, "Leaderboards": [None]}, None]},
    {"Game": {"GameId": 4}, "Maps": [{"Name": "nuke", "Leaderboards": None}]},
]


def test_details_of_one_pass_are_those_of_two(spark, folder):
    with open(f"{folder}/p.json", "w") as file:
        file.writelines(json.dumps(p) + "\n" for p in ODD_PAYLOADS)
    docs = files.read_payloads(spark, f"{folder}/p.json", PAYLOAD_SCHEMA, one_per_file=False)
    both = flatten_details(docs)
    assert plan(both).count("FileScan json") == 1
    for kind, flatten in (("map", flatten_maps), ("entry", flatten_leaderboards)):
        own, expected = both.where(F.col("kind") == kind).select(f"{kind}.*"), flatten(docs)
        assert own.columns == expected.columns
        assert Counter(map(str, own.collect())) == Counter(map(str, expected.collect()))


def test_payload_files_are_read_once_and_written_by_kind(spark, folder):
    feed = Feed(spark, folder)
    docs = spark.createDataFrame(
        [json.loads(json.dumps(ODD_PAYLOADS[0]))], PAYLOAD_SCHEMA, verifySchema=False
    )
    docs.write.parquet(f"{feed.lake.raw('payloads')}/batch=0")
    read = []
    whole = layers.drain

    def watched(stream, store, checkpoint):
        query = start(stream, store, checkpoint)
        finish([query])
        read.append([p["numInputRows"] for p in query.recentProgress])

    layers.drain = watched
    try:
        for _ in range(2):
            layers.explode_details(spark, feed.lake)
    finally:
        layers.drain = whole
    assert [sum(rows) for rows in read] == [1, 0]
    kinds = [n for n in os.listdir(f"{feed.lake.raw('details')}/batch=0") if "=" in n]
    assert sorted(kinds) == ["kind=entry", "kind=map"]


def files_stream(spark, folder, name, n):
    for i in range(n):
        spark.range(10).coalesce(1).write.parquet(f"{folder}/{name}/{i}")
    return files.stream_parquet(spark, f"{folder}/{name}", spark.range(1).schema, 1)


def test_streams_run_side_by_side(spark, folder):
    """Either waits for the other in its first batch, which only ends if both run."""
    meet, pools = threading.Barrier(2, timeout=120), {}

    def store(name, batch, number):
        if number == 0:
            meet.wait()
        pools[name] = batch.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool")

    queries = []
    for name in ("a", "b"):
        stream = files_stream(spark, folder, name, 2)
        own = lambda batch, number, name=name: store(name, batch, number)
        queries.append(start(stream, own, f"{folder}/{name}-checkpoint", pool=name))
    finish(queries, timeout=200)
    assert sorted(pools) == ["a", "b"] and not any(q.isActive for q in queries)
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_one_stream_that_fails_stops_the_others(spark, folder):
    done, failing = [], threading.Event()

    def fail(batch, number):
        failing.set()
        raise RuntimeError("no more of it")

    def slow(batch, number):
        failing.wait(60)
        done.append(number)

    queries = [
        start(files_stream(spark, folder, "slow", 30), slow, f"{folder}/slow-checkpoint"),
        start(files_stream(spark, folder, "fails", 1), fail, f"{folder}/fails-checkpoint"),
    ]
    with pytest.raises(Exception, match="no more of it"):
        finish(queries, timeout=200)
    assert not any(q.isActive for q in queries) and len(done) < 30
    # What was left is taken up by the next run, and nothing comes twice but the last.
    stream = files.stream_parquet(spark, f"{folder}/slow", spark.range(1).schema, 1)
    finish([start(stream, slow, f"{folder}/slow-checkpoint")], timeout=200)
    assert sorted(set(done)) == list(range(30)) and len(done) <= 31


SPEC = Measures(
    ("k", "name"), "game", parts="games", rows="rows", first={"lo": "at"}, last={"hi": "at"},
    means={"avg": "x"},
)
ROWS = [
    (1, "ann", 1, 5, 1.0), (1, "ann", 1, 7, None), (1, "ann", 2, 1, 4.0), (None, None, 2, 3, 2.0),
    (2, "bob", 2, 9, None), (2, "bob", None, 4, 8.0), (1, None, 3, None, 3.0),
]
COLUMNS = "k int, name string, game int, at int, x double"


def whole(rows):
    out = {}
    for k, name, *_ in rows:
        own = [r for r in rows if r[:2] == (k, name)]
        at = [r[3] for r in own if r[3] is not None]
        x = [r[4] for r in own if r[4] is not None]
        games = {r[2] for r in own} - {None}
        out[k, name] = (
            len(games), len(own), min(at, default=None), max(at, default=None),
            sum(x) / len(x) if x else None,
        )
    return out


def shown(stats):
    return {(r.k, r.name): (r.games, r.rows, r.lo, r.hi, r.avg) for r in stats.collect()}


def test_totals_of_partials_are_those_of_the_rows(spark):
    rows = spark.createDataFrame(ROWS, COLUMNS)
    assert shown(totals(partials(rows, SPEC), SPEC)) == whole(ROWS)
    none = rows.where("false")
    assert totals(partials(none, SPEC), SPEC).count() == 0


@pytest.mark.parametrize("at", range(len(ROWS)))
def test_a_row_is_withdrawn_or_moved(spark, at):
    """Whichever row goes, or goes to another key, only its part is computed again."""
    rows = spark.createDataFrame(ROWS, COLUMNS)
    old = partials(rows, SPEC)
    changed = spark.createDataFrame([(ROWS[at][2],)], "game int")
    for new in ([], [(7, "new", ROWS[at][2], 0, 1.5)]):
        after = ROWS[:at] + ROWS[at + 1 :] + new
        current = spark.createDataFrame(after, COLUMNS)
        fresh = partials_of(current, changed, SPEC)
        stored = replaced(old, fresh, changed, "game")
        assert shown(totals(stored, SPEC)) == whole(after)
        touched = touched_keys(old, fresh, changed, SPEC)
        stats = totals(old, SPEC)
        kept = without_keys(stats, touched, SPEC)
        both = kept.unionByName(totals(of_keys(stored, touched, SPEC), SPEC))
        assert shown(both) == whole(after)


def test_a_change_that_stopped_half_way_gives_all_keys_again(spark, folder, monkeypatch):
    """A player's only game is corrected to another name; the run stops once the partial
    rows are replaced and before the statistics are."""
    path, work = f"{folder}/partials", f"{folder}/work"
    rows = spark.createDataFrame(ROWS, COLUMNS)
    refresh = stored_partials.refresh_partials
    refresh(spark, path, f"{folder}/work-0", rows, rows, SPEC, 4)
    after = [r if r[0] != 2 else (2, "bobby", *r[2:]) for r in ROWS]
    current, changed = spark.createDataFrame(after, COLUMNS), rows.where("k = 2")
    for _ in range(2):
        stored, keys = refresh(spark, path, work, current, changed, SPEC, 4)
        assert {(2, "bob"), (2, "bobby")} <= {tuple(r) for r in keys.collect()}
        assert shown(totals(stored, SPEC)) == whole(after)
    monkeypatch.setattr(stored_partials, "overwrite_partitions", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(spark, path, f"{folder}/work-2", rows, changed, SPEC, 4)
    assert shown(totals(stored, SPEC)) == whole(after)
    assert refresh(spark, path, f"{folder}/work-3", rows, changed.where("false"), SPEC, 4) is None


def test_only_folders_of_changed_games_are_written(spark, folder):
    path = f"{folder}/partials"
    rows = spark.range(64).select(
        F.lit(1).alias("k"), F.lit("a").alias("name"), F.col("id").cast("int").alias("game"),
        F.lit(1).alias("at"), F.lit(1.0).alias("x"),
    )
    stored_partials.refresh_partials(spark, path, f"{folder}/w0", rows, rows, SPEC, 8)
    listed = lambda: {
        n: sorted(f for f in os.listdir(f"{path}/{n}") if f.endswith(".parquet"))
        for n in os.listdir(path)
        if n.startswith("bucket=")
    }
    before = listed()
    assert len(before) == 8
    stored_partials.refresh_partials(
        spark, path, f"{folder}/w1", rows, rows.where("game = 5"), SPEC, 8
    )
    after = listed()
    assert sum(before[n] != after[n] for n in before) == 1


def test_partial_rows_of_a_folder_are_written_by_several_tasks(spark, folder):
    rows = spark.range(400).select(
        F.lit(1).alias("k"), F.lit("a").alias("name"), F.col("id").cast("int").alias("game"),
        F.lit(1).alias("at"), F.lit(1.0).alias("x"),
    )
    path = f"{folder}/partials"
    stored, _ = stored_partials.refresh_partials(
        spark, path, f"{folder}/w", rows, rows, SPEC, 2, rows_per_file=20
    )
    sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
    assert stored.count() == 400 and len(sizes) > 8 and max(sizes) < 100


def test_partial_rows_are_shuffled_once(spark):
    rows = spark.createDataFrame(ROWS, COLUMNS)
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        with session_setting(spark, "spark.sql.adaptive.enabled", "false"):
            fresh = partials_of(rows, rows.select("game"), SPEC)
            given = fresh._jdf.queryExecution().executedPlan().children().apply(0).toString()
    # Either side of the join by part, which the aggregate then takes as it lies.
    assert "Join" in given and given.count("Exchange hashpartitioning") == 2


def games(spark, first, last):
    return spark.range(first, last).select(
        F.lit(1).alias("k"), F.lit("a").alias("name"), F.col("id").cast("int").alias("game"),
        F.lit(1).alias("at"), F.lit(1.0).alias("x"),
    )


def parquet_files(path):
    return {str(f) for f in Path(path).glob("bucket=*/*.parquet")}


def test_rows_of_new_games_leave_stored_files_alone(spark, folder, monkeypatch):
    path, whole = f"{folder}/partials", games(spark, 0, 96)
    refresh = stored_partials.refresh_partials
    refresh(spark, path, f"{folder}/w0", whole, games(spark, 0, 32), SPEC, 4)
    first = parquet_files(path)
    stored, _ = refresh(spark, path, f"{folder}/w1", whole, games(spark, 32, 64), SPEC, 4)
    second = parquet_files(path)
    assert first < second and stored.count() == 64
    # Once the files of a folder are many and small, they are written again.
    monkeypatch.setattr(stored_partials, "_MOST_FILES", 1)
    stored, keys = refresh(spark, path, f"{folder}/w2", whole, games(spark, 64, 96), SPEC, 4)
    assert not second & parquet_files(path) and stored.count() == 96
    assert shown(totals(stored, SPEC)) == {(1, "a"): (96, 96, 1, 1, 1.0)} and keys.count() == 1


@pytest.mark.parametrize("first", [0, 32])
def test_a_move_that_stopped_half_way_is_repeated(spark, folder, monkeypatch, first):
    path, whole = f"{folder}/partials", games(spark, 0, 64)
    refresh, move = stored_partials.refresh_partials, stored_partials.move_files
    if first:
        refresh(spark, path, f"{folder}/w0", whole, games(spark, 0, first), SPEC, 4)
    moved = []

    def stopped(spark, source, into):
        if len(moved) == 2:
            raise OSError("stopped")
        moved.append(move(spark, source, into))

    monkeypatch.setattr(stored_partials, "move_files", stopped)
    with pytest.raises(OSError, match="stopped"):
        refresh(spark, path, f"{folder}/w1", whole, games(spark, first, 64), SPEC, 4)
    monkeypatch.setattr(stored_partials, "move_files", move)
    stored, _ = refresh(spark, path, f"{folder}/w1", whole, games(spark, first, 64), SPEC, 4)
    assert stored.count() == 64
    assert shown(totals(stored, SPEC)) == {(1, "a"): (64, 64, 1, 1, 1.0)}


def test_days_with_many_rows_are_found_without_a_shuffle(spark, folder, monkeypatch):
    plans = []
    monkeypatch.setattr(files, "overwrite_partitions", lambda df, *_: plans.append(plan(df)))
    with session_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        files.overwrite_days(dated(spark, (1, "2023-01-01")), f"{folder}/raw", "day")
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]


def test_raw_rows_are_not_sorted_by_kind(spark, folder, monkeypatch):
    feed, seen = Feed(spark, folder), []
    docs = spark.createDataFrame(
        [json.loads(json.dumps(ODD_PAYLOADS[0]))], PAYLOAD_SCHEMA, verifySchema=False
    )
    docs.write.parquet(f"{feed.lake.raw('payloads')}/batch=0")
    setting = layers.session_setting

    def noted(session, name, value):
        seen.append((name, value))
        return setting(session, name, value)

    monkeypatch.setattr(layers, "session_setting", noted)
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    layers.explode_details(spark, feed.lake)
    assert seen == [(name, "2")] and spark.conf.get(name) == before


def test_documents_are_compressed_in_files_of_bounded_size(spark, folder):
    docs = spark.range(50).select(F.struct(F.col("id").cast("int").alias("GameId")).alias("Game"))
    files.write_documents(docs.coalesce(1), f"{folder}/d", per_file=20)
    names = [n for n in os.listdir(f"{folder}/d") if n.startswith("part-")]
    assert len(names) == 3 and all(n.endswith(".gz") for n in names)
    back = files.read_payloads(spark, f"{folder}/d", docs.schema, one_per_file=False)
    assert sorted(r.Game.GameId for r in back.collect()) == list(range(50))


def test_a_corrected_entry_renames_its_player(spark, folder):
    """Through all layers: the new name takes the game, the old one keeps its others."""
    feed = Feed(spark, folder)
    feed.land(match(9, "2023-01-10", "2023-01-10T20:00:00"), match(10, "2023-01-10", "2023-01-10T20:00:00"))
    feed.deliver("9", payload(9, one_map(1, "dust", entry(1, "ann", 9, 10))))
    feed.deliver("10", payload(10, one_map(1, "dust", entry(1, "ann", 10, 20))))
    feed.run("new")
    assert players(feed) == {(1, "ann"): (2, 15.0)}
    late = entry(1, "anna", 10, 30.0, updated="2023-01-11T20:00:00")
    docs = spark.createDataFrame(payload(10, one_map(1, "dust", late)), PAYLOAD_SCHEMA, verifySchema=False)
    docs.write.parquet(f"{feed.lake.raw('payloads')}/batch=later")
    layers.explode_details(spark, feed.lake)
    layers.refresh_details(spark, feed.lake)
    layers.refresh_silver(spark, feed.lake)
    assert players(feed) == {(1, "ann"): (1, 10.0), (1, "anna"): (1, 30.0)}
    assert not [n for n in os.listdir(feed.lake.silver(PLAYERS)) if n.startswith("work")]
    assert keyed.is_stored(spark, feed.lake.silver(PLAYERS))


def test_a_load_that_is_repeated_adds_nothing(spark, folder):
    feed = Feed(spark, folder)
    feed.land(match(1, "2023-01-09", "a"), match(2, "2023-01-10", "a"), match(3, "no day", "a"))
    landing = files.read_json(spark, feed.landing, MATCH_SCHEMA)
    for _ in range(2):
        layers.load_matches(spark, feed.lake, landing, "range", d1="2023-01-01", d2="2023-01-31")
    raw = files.read_days(spark, feed.lake.raw("match_history"), MATCH_SCHEMA)
    assert sorted(r.GameId for r in raw.collect()) == [1, 2]
    # Nothing newer: the frontier is told by the folders.
    layers.load_matches(spark, feed.lake, landing, "new", dt.date(2023, 1, 20))
    assert raw.count() == 2


def test_splits_of_a_stream_are_bounded(spark, folder, monkeypatch):
    from stratafeed.schemas import TableSpec
    from stratafeed.streaming import incremental

    monkeypatch.setattr(incremental, "_SPLIT_BYTES", 1 << 10)
    name, seen = "spark.sql.files.maxPartitionBytes", []
    rows = spark.range(1000).selectExpr("id", "id AS v").coalesce(1)
    rows.write.parquet(f"{folder}/in")
    clean = incremental.clean_batch

    def watched(batch, spec):
        seen.append(batch.rdd.getNumPartitions())
        return clean(batch, spec)

    monkeypatch.setattr(incremental, "clean_batch", watched)
    before = spark.conf.get(name)
    stream = files.stream_parquet(spark, f"{folder}/in", rows.schema)
    spec = TableSpec("t", rows.schema, ("id",))
    incremental.run_incremental(spark, stream, f"{folder}/t", spec)
    # The session has its own setting again.
    assert seen[0] > 2 and spark.conf.get(name) == before


def test_raw_rows_lie_in_bounded_row_groups(spark, folder, monkeypatch):
    from pyarrow import parquet

    monkeypatch.setattr(files, "ROW_GROUP_BYTES", 1 << 16)
    rows = spark.range(100_000).selectExpr("xxhash64(id) AS k").coalesce(1)
    files.append_parquet(rows, f"{folder}/raw")
    (part,) = Path(f"{folder}/raw").glob("*.parquet")
    assert parquet.ParquetFile(part).num_row_groups > 2
    assert spark.read.parquet(f"{folder}/raw").distinct().count() == 100_000
