from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratafeed.operators import (
    AmbiguousMergeError,
    ambiguous_matches,
    calendar_gaps,
    entity_stats,
    explode_children,
    flatten_leaderboards,
    flatten_maps,
    frontier,
    latest_version,
    merge_into_table,
    only_pending,
    pending,
    select_days,
    select_rows,
    side_counts,
    upsert,
)
from stratafeed.operators import days
from stratafeed.operators.merge import require_unambiguous
from stratafeed.schemas import LEADERBOARD_SCHEMA, MAP_SCHEMA, PAYLOAD_SCHEMA


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# Latest version


def test_latest_version_filters_before_ranking(spark):
    df = spark.createDataFrame(
        [
            (1, "2023-01-01", True, "old"),
            (1, "2023-01-02", True, "newer"),
            (1, "2023-01-03", False, "open"),
            (2, None, True, "no version"),
            (2, "2020-01-01", True, "versioned"),
            (3, "2023-01-01", None, "null gate"),
        ],
        "k int, v string, closed boolean, tag string",
    )
    latest = latest_version(df, ["k"], "v", where="closed")
    assert [(r.k, r.tag) for r in latest.orderBy("k").collect()] == [
        (1, "newer"),
        (2, "versioned"),
    ]


def test_latest_version_is_deterministic_on_ties(spark):
    data = [(1, 5, i, [i], {"m": i}) for i in range(50)]
    picked = set()
    for seed in range(4):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(
            data, "k int, v int, t int, a array<int>, m map<string,int>"
        ).repartition(seed + 1)
        picked.add(latest_version(df, ["k"], "v").first().t)
    assert picked == {49}


def test_latest_version_prunes_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    text = plan(latest_version(df, ["k"], "v"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


# Pending


def test_pending(spark):
    work = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    done = spark.createDataFrame([(2,), (2,), (None,)], "K int")
    assert rows(pending(work, done, ["k"])) == [(1,), (3,), (None,)]
    assert rows(pending(work, None, ["k"])) == [(1,), (2,), (3,), (None,)]
    assert rows(pending(work.dropna(), work, ["k"])) == []
    assert rows(only_pending(work, done, ["k"])) == [(1,), (1,), (3,), (None,)]
    assert "LeftAnti" in plan(pending(work, done, ["k"]))


# Upsert

STORED = [(1, 10, "s1"), (2, 20, "s2"), (3, None, "s3"), (4, 40, "s4")]
BATCH = [(1, 9, "b1"), (2, 20, "b2"), (3, None, "b3"), (4, None, "b4"), (5, 1, "b5")]


@pytest.fixture
def stored(spark):
    return spark.createDataFrame(STORED, "k int, v int, tag string")


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(BATCH, "k int, v int, tag string")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_upsert_plain_and_versioned(spark, stored, batch, threshold, null_safe):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        assert rows(upsert(stored, batch, ["k"], null_safe=null_safe)) == rows(batch)
        guarded = upsert(stored, batch, ["k"], version="v", null_safe=null_safe)
        assert [r.tag for r in guarded.orderBy("k").collect()] == [
            "s1",
            "b2",
            "b3",
            "s4",
            "b5",
        ]
    finally:
        spark.conf.set(key, before)


def test_upsert_keeps_target_columns(spark, stored):
    source = spark.createDataFrame(
        [("x", 7, 1, "extra")], "tag string, v int, k int, helper string"
    )
    merged = upsert(stored, source, ["k"])
    assert merged.columns == ["k", "v", "tag"]
    assert (1, 7, "x") in rows(merged)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_upsert_null_keys_with_a_version(spark, threshold):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        schema = "k string, l string, v int"
        one = spark.createDataFrame([(None, "a", 5), ("x", None, 5), ("y", "b", 5)], schema)
        two = spark.createDataFrame([(None, "a", 4), ("x", None, 6), ("y", "b", 4)], schema)
        apart = rows(upsert(one, two, ["k", "l"], version="v"))
        assert apart == rows(one.unionAll(two.where("k is null or l is null")))
        together = rows(upsert(one, two, ["k", "l"], version="v", null_safe=True))
        assert together == sorted([(None, "a", 5), ("x", None, 6), ("y", "b", 5)], key=repr)
    finally:
        spark.conf.set(key, before)


def test_upsert_null_keys(spark):
    one = spark.createDataFrame([(None, "a", 1), ("x", None, 2)], "k string, l string, n int")
    two = spark.createDataFrame([(None, "a", 3), ("x", None, 4)], "k string, l string, n int")
    assert upsert(one, two, ["k", "l"]).count() == 4
    assert rows(upsert(one, two, ["k", "l"], null_safe=True)) == rows(two)


def test_upsert_is_idempotent_and_order_free_when_guarded(spark):
    rng = random.Random(7)
    versions = [(k, v, f"{k}-{v}") for k in range(12) for v in rng.sample(range(99), 6)]
    schema = "k int, v int, tag string"
    expected = rows(latest_version(spark.createDataFrame(versions, schema), ["k"], "v"))
    for _ in range(3):
        rng.shuffle(versions)
        table = spark.createDataFrame([], schema)
        for start in range(0, len(versions), 24):
            piece = spark.createDataFrame(versions[start : start + 24], schema)
            piece = latest_version(piece, ["k"], "v")
            table = upsert(table, piece, ["k"], version="v")
            table = spark.createDataFrame(table.collect(), schema)
        assert rows(table) == expected
        assert rows(upsert(table, table, ["k"], version="v")) == expected


def test_small_batch_does_not_shuffle_the_table(spark, folder):
    spark.range(100_000).selectExpr("id AS k", "id AS v").write.parquet(f"{folder}/t")
    spark.range(10).selectExpr("id AS k", "id + 1 AS v").write.parquet(f"{folder}/b")
    table, piece = (spark.read.parquet(f"{folder}/{n}") for n in "tb")
    for version in (None, "v"):
        merged = upsert(
            table, piece, ["k"], version=version, null_safe=True, unique=True
        )
        merged.collect()
        assert "Exchange hashpartitioning" not in plan(merged)


def test_ambiguous_matches(spark, stored):
    source = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "b"), (9, 1, "c"), (9, 2, "d")], "k int, v int, tag string"
    )
    assert rows(ambiguous_matches(stored, source, ["k"])) == [(1, 2)]
    with pytest.raises(AmbiguousMergeError):
        require_unambiguous(stored, source, ["k"])
    require_unambiguous(stored, source.where("k = 9"), ["k"])


def test_merge_into_table_is_one_merge_command(spark, stored, batch):
    """Plain parquet tables refuse MERGE; the command itself must get that far."""
    stored.write.mode("overwrite").format("parquet").saveAsTable("merge_target")
    for version in (None, "v"):
        with pytest.raises(Exception, match="MERGE INTO TABLE"):
            merge_into_table(batch, "merge_target", ["k"], version=version)


# Days


def feed(spark, *days):
    return spark.createDataFrame(
        [(f"{d}T00:00:00", i) for i, d in enumerate(days)], "Day string, n int"
    )


def loaded(df):
    return sorted(r.Day[:10] for r in df.collect())


TODAY = dt.date(2023, 1, 20)
LANDING = ["2023-01-01", *[f"2023-01-{d:02}" for d in range(3, 12)], "2023-01-15"]
LANDING += ["2023-01-20", "2023-01-21", "2023-01-22"]


def test_new_days(spark):
    landing, stored = feed(spark, *LANDING), feed(spark, "2023-01-10", "2023-01-11")
    new = select_rows(landing, stored, "new", "Day", TODAY)
    assert loaded(new) == ["2023-01-15", "2023-01-20", "2023-01-21"]
    listed = select_days(landing, stored, "new", "Day", TODAY)
    assert rows(listed) == [(dt.date(2023, 1, d),) for d in (15, 20, 21)]


def test_first_load(spark):
    landing = feed(spark, *LANDING)
    gap = dt.date(2023, 1, 18)
    nothing = landing.limit(0)
    for stored in (None, nothing):
        assert loaded(select_rows(landing, stored, "new", "Day", TODAY)) == ["2023-01-20"]
        assert loaded(select_rows(landing, stored, "new", "Day", gap)) == ["2023-01-15"]
        history = loaded(select_rows(landing, stored, "history", "Day", TODAY))
        assert history == sorted(d for d in LANDING if d <= "2023-01-20")[-8:]


def test_history_days(spark):
    landing = feed(spark, *LANDING, "2023-01-04")
    stored = feed(spark, "2023-01-11", "2023-01-15")
    back = loaded(select_rows(landing, stored, "history", "Day", TODAY))
    assert back == sorted([f"2023-01-{d:02}" for d in range(4, 11)] + ["2023-01-04"])
    stored = feed(spark, "2023-01-04")
    assert loaded(select_rows(landing, stored, "history", "Day", TODAY)) == [
        "2023-01-01",
        "2023-01-03",
    ]


def test_date_and_range(spark):
    landing = feed(spark, *LANDING)

    def take(mode, **days):
        return loaded(select_rows(landing, None, mode, "Day", **days))

    assert take("date", d1="2023-01-15") == ["2023-01-15"]
    assert take("date", d1="2023-01-16") == []
    assert take("range", d1="2023-01-10", d2="2023-01-15") == [
        "2023-01-10",
        "2023-01-11",
        "2023-01-15",
    ]
    for days in ({"d1": "2023-01-15", "d2": "2023-01-15"}, {"d1": "2023-01-16"}):
        with pytest.raises(ValueError):
            take("range", **({"d2": "2023-01-15"} | days))
    with pytest.raises(ValueError):
        take("date", d1="2023-02-30")
    with pytest.raises(ValueError):
        take("sometimes")


def test_range_reaches_the_scan(spark, folder):
    spark.sql("SELECT TIMESTAMP_NTZ '2023-01-15 10:00:00' AS Day").write.parquet(
        f"{folder}/landing"
    )
    landing = spark.read.parquet(f"{folder}/landing")
    chosen = select_rows(landing, None, "range", "Day", d1="2023-01-10", d2="2023-01-15")
    assert "GreaterThanOrEqual(Day,2023-01-10" in plan(chosen)
    assert chosen.count() == 1


def test_frontier_and_gaps(spark):
    landing = feed(spark, "2023-01-01", "2023-01-04", "2023-01-04")
    assert rows(frontier(landing, "Day")) == [(dt.date(2023, 1, 1), dt.date(2023, 1, 4))]
    assert rows(calendar_gaps(landing, "Day")) == [
        (dt.date(2023, 1, 2),),
        (dt.date(2023, 1, 3),),
    ]
    assert rows(calendar_gaps(landing.limit(0), "Day")) == []


# Statistics


def test_entity_stats_null_keys_and_measures(spark):
    df = spark.createDataFrame(
        [
            (1, "a", 7, "2023-01-02", 1.0),
            (1, "a", 7, "2023-01-01", None),
            (1, "b", 8, "2023-01-03", 4.0),
            (None, None, 9, None, None),
            (None, None, None, None, 3.0),
        ],
        "p int, name string, game int, at string, kills float",
    )
    stats = entity_stats(
        df,
        ["p", "name"],
        {"games": "game"},
        {"first": "at"},
        {"last": "at"},
        {"kills": "kills"},
    )
    assert stats.columns == ["p", "name", "games", "first", "last", "kills"]
    assert rows(stats) == [
        (1, "a", 1, "2023-01-01", "2023-01-02", 1.0),
        (1, "b", 1, "2023-01-03", "2023-01-03", 4.0),
        (None, None, 1, None, None, 3.0),
    ]


def test_side_counts(spark, folder):
    df = spark.createDataFrame(
        [("x", "y", "m"), ("y", "x", "m"), ("x", None, "n"), ("x", "x", "n")],
        "a string, b string, name string",
    )
    df.write.parquet(f"{folder}/maps")
    counts = side_counts(
        spark.read.parquet(f"{folder}/maps"), ["a", "b"], {"map": "name"}, "team", "n"
    )
    assert rows(counts) == [("x", "m", 2), ("x", "n", 3), ("y", "m", 2), (None, "n", 1)]
    assert counts.agg(F.sum("n")).first()[0] == 2 * df.count()
    assert plan(counts).split("== Initial Plan ==")[-1].count("FileScan") == 1


# Nested


def test_flatten(spark):
    payloads = spark.createDataFrame(
        [
            (
                {"GameId": 1, "TeamAName": "x", "TeamBName": "y"},
                [
                    {"Number": 1, "Name": "m1", "Leaderboards": [player(1), player(2)]},
                    {"Number": 2, "Name": "m2", "Leaderboards": None},
                    {"Number": 3, "Name": "m3", "Leaderboards": []},
                ],
            ),
            ({"GameId": 2}, []),
            ({"GameId": 3}, None),
        ],
        PAYLOAD_SCHEMA,
    )
    maps = flatten_maps(payloads)
    assert maps.columns == MAP_SCHEMA.names
    assert [(r.Number, r.Name, r.GameId, r.TeamAName) for r in maps.collect()] == [
        (1, "m1", 1, "x"),
        (2, "m2", 1, "x"),
        (3, "m3", 1, "x"),
    ]
    entries = flatten_leaderboards(payloads)
    assert entries.columns == LEADERBOARD_SCHEMA.names
    assert [(r.PlayerId, r.MapName) for r in entries.collect()] == [(1, "m1"), (2, "m1")]


def test_flattening_reads_only_its_own_fields(spark, folder):
    spark.createDataFrame([], PAYLOAD_SCHEMA).write.parquet(f"{folder}/p")
    payloads = spark.read.schema(PAYLOAD_SCHEMA).parquet(f"{folder}/p")
    assert "Leaderboards" not in read_schema(flatten_maps(payloads))
    entries = read_schema(flatten_leaderboards(payloads))
    assert "Leaderboards" in entries
    assert "Game:" not in entries and "CurrentRound" not in entries


def read_schema(df) -> str:
    scans = df._jdf.queryExecution().executedPlan().collectLeaves()
    return scans.head().requiredSchema().catalogString()


def player(number):
    fields = {
        "PlayerId": number,
        "TeamId": 1,
        "Name": "n",
        "MatchName": "n",
        "Team": "t",
        "IsClosed": True,
        "GameId": 1,
        "OpponentId": 2,
        "Opponent": "o",
    }
    return fields


def test_explode_children_of_chosen_fields(spark):
    df = spark.sql("SELECT 1 AS id, array(named_struct('a', 1, 'b', array(2))) AS xs")
    assert rows(explode_children(df, "xs", {"id": "id"})) == [(1, 1)]
    assert rows(explode_children(df, "xs", {}, ["b"])) == [([2],)]


def test_no_python_in_any_plan(spark, stored, batch):
    for df in (
        upsert(stored, batch, ["k"], version="v"),
        latest_version(stored, ["k"], "v"),
        pending(stored, batch, ["k"]),
    ):
        assert "Python" not in plan(df)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_upsert_reduces_repeated_source_keys(spark, threshold):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        schema = "k string, v int"
        one = spark.createDataFrame([("a", 2)], schema)
        two = spark.createDataFrame([("a", 1), ("a", 3), (None, 1), (None, 2)], schema)
        apart = upsert(one, two, ["k"], version="v")
        assert rows(apart) == rows(spark.createDataFrame([("a", 3), (None, 1), (None, 2)], schema))
        assert rows(upsert(one, two.where("k = 'a'"), ["k"])) == [("a", 3)]
        twice = spark.createDataFrame([("a", 1), ("a", 5)], schema)
        newer = spark.createDataFrame([("a", 3)], schema)
        assert rows(upsert(twice, newer, ["k"], version="v")) == [("a", 1), ("a", 5)]
    finally:
        spark.conf.set(key, before)


def test_pending_rows_with_null_keys_go_round_the_join(spark):
    rows = spark.createDataFrame(
        [(1, None), (None, 2), (None, 2), (3, 4), (5, 6)], "a int, b int"
    )
    done = spark.createDataFrame([(3, 4), (None, 2), (None, None)], "a int, b int")
    fresh = only_pending(rows, done, ["a", "b"])
    assert sorted(map(repr, fresh.collect())) == sorted(
        map(repr, rows.where("a IS NULL OR b IS NULL OR a = 5").collect())
    )


def test_text_days_reach_the_scan(spark, folder):
    texts = ["2023-01-08T23:59:59", "2023-01-09", "2023-01-11T10:00:00", "2023-01-12",
             "2023-01-10x", "2023-01-99", None]
    spark.createDataFrame([(t,) for t in texts], "Day string").write.parquet(folder + "/feed")
    feed = spark.read.parquet(folder + "/feed")
    chosen = days.select_rows(feed, None, "range", "Day", d1="2023-01-09", d2="2023-01-11")
    assert {r.Day for r in chosen.collect()} == {"2023-01-09", "2023-01-11T10:00:00"}
    plan = chosen._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(Day,2023-01-09)" in plan
    assert "LessThan(Day,2023-01-12)" in plan
    found = days.find_range(feed, None, "history", "Day", dt.date(2023, 1, 11))
    assert found == (dt.date(2023, 1, 8), dt.date(2023, 1, 12))
    nothing = feed.where("Day IS NULL")
    assert days.find_range(nothing, None, "new", "Day", dt.date(2023, 1, 11)) is None
