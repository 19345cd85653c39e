"""Keyed tables, files, catalog."""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafeed.operators import AmbiguousMergeError
from stratafeed.plans import refresh_sql_table, run_sql_table
from stratafeed.schemas import PAYLOAD_SCHEMA, TableSpec
from stratafeed.sources import catalog, files, keyed
from stratafeed.sources.storage import (
    CHECKPOINT_DIR,
    exists,
    is_complete,
    list_folders,
    new_folder,
    shared_folder,
)

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("v", T.LongType()),
        T.StructField("tag", T.StringType()),
    ]
)
GUARDED = TableSpec("t", SCHEMA, ("k",), "v")
PLAIN = TableSpec("t", SCHEMA, ("k",))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def put(spark, folder):
    def write(number, *data):
        df = spark.createDataFrame(list(data), SCHEMA)
        keyed.write_increment(df, folder, number)

    return write


def test_absent_table_is_empty(spark, folder):
    current = keyed.read_current(spark, f"{folder}/none", GUARDED)
    assert current.columns == SCHEMA.names and current.count() == 0
    assert keyed.compact(spark, f"{folder}/none", GUARDED) is None


def test_increments_over_base(spark, folder, put):
    put(0, ("a", 5, "a5"), ("b", 5, "b5"), (None, 1, "n1"))
    put(1, ("a", 4, "a4"), ("b", 6, "b6"), ("c", None, "c?"))
    expected = [("a", 5, "a5"), ("b", 6, "b6"), ("c", None, "c?"), (None, 1, "n1")]
    assert rows(keyed.read_current(spark, folder, GUARDED)) == expected
    keyed.compact(spark, folder, GUARDED)
    assert keyed.open_increments(spark, folder) == 0
    assert rows(keyed.read_current(spark, folder, GUARDED)) == expected
    put(2, ("b", 6, "tie"), ("c", 1, "c1"), (None, 0, "n0"), ("d", 1, "d1"))
    assert rows(keyed.read_current(spark, folder, GUARDED)) == [
        ("a", 5, "a5"),
        ("b", 6, "tie"),
        ("c", 1, "c1"),
        ("d", 1, "d1"),
        (None, 1, "n1"),
    ]
    assert [t for *_, t in rows(keyed.read_current(spark, folder, PLAIN))] == [
        "a5",
        "tie",
        "c1",
        "d1",
        "n0",
    ]


def test_increments_are_sorted_once(spark, folder):
    for number in range(2):
        rows = spark.createDataFrame([("a", number, "x"), ("b", number, "y")], SCHEMA)
        keyed.write_increment(rows, f"{folder}/t", number)
    current = keyed.read_current(spark, f"{folder}/t", PLAIN)
    text = current._jdf.queryExecution().executedPlan().toString()
    # Printed from the last step to the first.
    assert text.rindex("Sort [") < text.index("Exchange hashpartitioning")
    assert sorted(r.v for r in current.collect()) == [1, 1]


def test_repeated_batch_changes_nothing(spark, folder, put):
    put(0, ("a", 1, "x"))
    put(1, ("a", 2, "y"))
    keyed.compact(spark, folder, GUARDED)
    put(1, ("a", 2, "y"))
    assert rows(keyed.read_current(spark, folder, GUARDED)) == [("a", 2, "y")]
    with pytest.raises(ValueError, match="base"):
        folder_of_base = f"{folder}/base=7"
        spark.createDataFrame([("a", 3, "z")], SCHEMA).write.parquet(folder_of_base)
        put(5, ("a", 4, "lost"))


def test_uncommitted_folders_do_not_count(spark, folder, put):
    put(0, ("a", 1, "x"))
    put(1, ("a", 2, "y"))
    os.remove(f"{folder}/increment=1/_SUCCESS")
    assert rows(keyed.read_current(spark, folder, GUARDED)) == [("a", 1, "x")]
    assert not is_complete(spark, f"{folder}/increment=1")


def test_upsert_table(spark, folder):
    def source(*data):
        return spark.createDataFrame(list(data), SCHEMA)

    keyed.upsert_table(spark, folder, PLAIN, source(("a", 1, "x"), (None, 1, "n")))
    keyed.upsert_table(spark, folder, PLAIN, source(("b", 1, "y"), (None, 2, "m")))
    expected = [("a", 1, "x"), ("b", 1, "y"), (None, 2, "m")]
    assert rows(keyed.read_current(spark, folder, PLAIN)) == expected
    with pytest.raises(AmbiguousMergeError):
        keyed.upsert_table(
            spark, folder, PLAIN, source(("a", 1, "x"), ("a", 2, "x"))
        )
    assert rows(keyed.read_current(spark, folder, PLAIN)) == expected


def test_only_a_missing_path_is_tolerated(spark, folder):
    assert files.read_if_present(spark, f"{folder}/none", SCHEMA) is None
    assert files.read_if_present(spark, f"{folder}/none", SCHEMA, "json") is None
    with pytest.raises(Exception, match="no_such_scheme"):
        files.read_if_present(spark, "no_such_scheme://x/y", SCHEMA)
    files.append_parquet(spark.createDataFrame([("a", 1, "x")], SCHEMA), f"{folder}/p")
    assert files.read_if_present(spark, f"{folder}/p", SCHEMA).count() == 1


def test_payload_files(spark, folder):
    def write(name, document):
        with open(f"{folder}/{name}.json", "w") as file:
            json.dump(document, file, indent=1)

    game = {"GameId": 1, "TeamAName": "x"}
    write("1", [{"Game": game, "Maps": [{"Number": 1, "Leaderboards": [{"Kills": 3}]}]}])
    write("2", [])
    write("3", [{"Game": None, "Maps": None}])
    write("4", [{"Game": {"GameId": 4}, "Maps": []}])
    payloads = files.read_payloads(spark, folder, PAYLOAD_SCHEMA)
    first = payloads.where("Game.GameId = 1").first()
    assert first.Maps[0].Leaderboards[0].Kills == 3.0
    landable = files.select_landable(payloads, None, "Game.GameId", "GameId")
    assert {r.Game.GameId for r in landable.collect()} == {1, 4}
    landed = files.ids_of(landable.where("Game.GameId = 1"), "Game.GameId", "GameId")
    left = files.select_landable(payloads, landed, "Game.GameId", "GameId")
    assert [r.Game.GameId for r in left.collect()] == [4]


def test_json_files_keep_microseconds_and_drop_nulls(spark, folder):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2023-01-05 01:02:03.000004' AS t, "
                   "CAST(NULL AS STRING) AS s")
    files.append_json(df, f"{folder}/j")
    assert rows(files.read_json(spark, f"{folder}/j", df.schema)) == rows(df)
    assert "s" not in json.loads(spark.read.text(f"{folder}/j").first()[0])


def test_shared_folder_comes_from_the_session(spark, folder):
    before = spark.conf.get(CHECKPOINT_DIR)
    assert shared_folder(spark) == before
    assert new_folder(spark, "x").startswith(f"{before}/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert exists(spark, folder) and not exists(spark, f"{folder}/none")
    os.makedirs(f"{folder}/sub")
    assert list_folders(spark, folder) == ["sub"]
    assert list_folders(spark, f"{folder}/none") == []


def test_shared_folder_when_none_is_named():
    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert shared_folder(session("local[2]")) == shared_folder(session("local[*]"))
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        shared_folder(session("spark://somewhere:7077"))


def test_catalog(spark, folder):
    catalog.ensure_database(spark, "cat_db")
    catalog.ensure_database(spark, "cat_db")
    assert not catalog.table_exists(spark, "cat_db", "t")
    df = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    catalog.save_table(df, "cat_db.t")
    catalog.save_table(df, "cat_db.t")
    assert catalog.table_exists(spark, "cat_db", "t")
    assert rows(spark.table("cat_db.t")) == rows(df)
    with open(f"{folder}/s.json", "w") as file:
        file.write(SCHEMA.json())
    assert catalog.load_schema(f"{folder}/s.json") == SCHEMA
    with open(f"{folder}/q.sql", "w") as file:
        file.write("SELECT k, count(*) AS v\nFROM cat_db.t GROUP BY k;\n")
    query = catalog.load_query(f"{folder}/q.sql")
    assert rows(run_sql_table(spark, query)) == [("a", 1)]
    assert run_sql_table(spark, "SELECT * FROM given", {"given": df}).count() == 1


def test_sql_table_is_merged_and_published(spark, folder):
    """A null group is updated in place; a group that vanished stays."""
    spec = TableSpec(
        "counts",
        T.StructType(
            [T.StructField("team", T.StringType()), T.StructField("n", T.LongType())]
        ),
        ("team",),
    )
    sql = "SELECT team, count(*) AS n FROM appearances GROUP BY team"
    for teams, expected in (
        (["x", "x", None], [("x", 2), (None, 1)]),
        (["y", None, None], [("x", 2), ("y", 1), (None, 2)]),
        (["y", None, None], [("x", 2), ("y", 1), (None, 2)]),
    ):
        data = spark.createDataFrame([(t,) for t in teams], "team string")
        result = run_sql_table(spark, sql, {"appearances": data})
        refresh_sql_table(spark, "sql_db", f"{folder}/counts", spec, result)
        assert rows(spark.table("sql_db.counts")) == expected
    assert spark.table("sql_db.counts").where(F.col("team") == "x").count() == 1


def test_views_of_the_session_are_left_alone(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    df.limit(1).createOrReplaceTempView("given_view")
    sql = "SELECT count(*) AS n FROM given_view"
    assert rows(run_sql_table(spark, sql, {"given_view": df})) == [(2,)]
    assert rows(spark.sql(sql)) == [(1,)]
    run_sql_table(spark, "SELECT * FROM other_view", {"other_view": df})
    assert not spark.catalog.tableExists("other_view")
    spark.catalog.dropTempView("given_view")


def test_names_are_quoted(spark, folder):
    df = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    files.append_parquet(df, f"{folder}/odd`name")
    catalog.ensure_database(spark, "quoted_db")
    catalog.publish_folder(spark, "quoted_db.order", f"{folder}/odd`name")
    assert rows(spark.table("quoted_db.`order`")) == rows(df)


def test_work_does_not_grow_with_what_was_folded(spark, folder, monkeypatch):
    """Folders of old batches cost nothing, and go when asked for."""
    asked = []
    monkeypatch.setattr(
        keyed, "is_complete", lambda s, p: asked.append(p) or is_complete(s, p)
    )
    counts = []
    for folded in (5, 50):
        table = f"{folder}/{folded}"
        for kind in ("base", "increment"):
            for n in range(folded + 1):
                os.makedirs(f"{table}/{kind}={n}")
        for name in (f"base={folded}", f"increment={folded + 1}"):
            df = spark.createDataFrame([(name, 1, "x")], SCHEMA)
            df.write.mode("overwrite").parquet(f"{table}/{name}")
        asked.clear()
        assert keyed.open_increments(spark, table) == 1
        assert keyed.read_current(spark, table, PLAIN).count() == 2
        counts.append(len(asked))
        keyed.remove_superseded(spark, table)
        assert sorted(os.listdir(table)) == sorted(
            [f"base={folded}", f"increment={folded}", f"increment={folded + 1}"]
        )
        assert keyed.read_current(spark, table, PLAIN).count() == 2
    assert counts[0] == counts[1]
