"""Bucketed tables, tables by SQL in order, bounded and archived intake, drifted documents."""

from __future__ import annotations

import os
from itertools import takewhile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratafeed.operators import drift
from stratafeed.plans import run_sql_tables
from stratafeed.sources import bucketed, catalog, files
from stratafeed.streaming import finish, start


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_batches(spark):
    """No batch fits under the broadcast threshold."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def rows(spark, *given):
    return spark.createDataFrame(list(given), "k int, part string, at int, v string")


KEYS = ["k", "part"]


def test_a_large_batch_leaves_the_stored_side_in_place(spark, large_batches):
    catalog.ensure_database(spark, "buckets_db")
    name = "buckets_db.stays"
    stored = spark.range(100).select(
        F.col("id").cast("int").alias("k"), F.concat(F.lit("p"), F.col("id") % 3).alias("part"),
        F.lit(5).alias("at"), F.lit("old").alias("v"),
    )
    bucketed.save_bucketed(stored.repartition(8, *KEYS), name, KEYS, 8)
    batch = stored.withColumns({"v": F.lit("new"), "at": F.col("k") % 10})
    merged = bucketed.merged_bucketed(spark, name, batch, KEYS, 8, version="at", unique=True)
    text = plan(merged)
    # Exchanges are above the rows of the batch, none above a scan of the table.
    assert "SortMergeJoin" in text and "Broadcast" not in text
    # Rows with a null key, which match nothing, go round the joins in any order.
    assert (text.count("Bucketed: true"), text.count("FileScan parquet")) == (3, 4)
    lines = text.splitlines()
    depth = [len(x) - len(x.lstrip(" :+-*(0123456789)")) for x in lines]
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert exchanges
    for i in exchanges:
        below = takewhile(lambda j: depth[j] > depth[i], range(i + 1, len(lines)))  # noqa: B023
        assert not any("FileScan" in lines[j] for j in below)
    bucketed.upsert_bucketed(spark, name, batch, KEYS, 8, version="at", unique=True)
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert got == {k: "new" if k % 10 >= 5 else "old" for k in range(100)}


def test_bucketed_upserts_one_after_another(spark):
    catalog.ensure_database(spark, "buckets_db")
    name = "buckets_db.steps"
    first = rows(spark, (1, "a", 1, "x"), (1, "a", 2, "y"), (None, "a", 1, "n"), (2, None, 1, "m"))
    second = rows(spark, (1, "a", 1, "late"), (3, "b", 1, "z"), (None, "a", 9, "n2"))
    bucketed.upsert_bucketed(spark, name, first, KEYS, 4, version="at")
    for _ in range(2):
        bucketed.upsert_bucketed(spark, name, second.where("k IS NOT NULL"), KEYS, 4, version="at")
    bucketed.upsert_bucketed(spark, name, second.where("k IS NULL"), KEYS, 4, version="at")
    got = sorted(map(str, (tuple(r) for r in spark.table(name).collect())))
    assert got == sorted(
        map(str, [(1, "a", 2, "y"), (None, "a", 1, "n"), (None, "a", 9, "n2"), (2, None, 1, "m"), (3, "b", 1, "z")])
    )
    bucketed.upsert_bucketed(spark, name, second.where("false"), KEYS, 4, version="at")
    assert spark.table(name).count() == 5


def test_queries_in_order_of_dependence(spark):
    base = spark.range(5).withColumnRenamed("id", "n")
    queries = {
        "top": "SELECT m.n FROM middle m WHERE n > (SELECT avg(n) FROM low)",
        "middle": "WITH low AS (SELECT 3 AS n) SELECT n FROM low UNION ALL SELECT n FROM given",
        "low": "SELECT n + 1 AS n FROM given",
    }
    base.createOrReplaceTempView("low")
    got = run_sql_tables(spark, queries, {"given": base})
    assert list(got) == ["middle", "low", "top"]
    assert sorted(r.n for r in got["top"].collect()) == [4]
    assert sorted(r.n for r in got["low"].collect()) == [1, 2, 3, 4, 5]
    # The view of the session is as before.
    assert sorted(r.n for r in spark.table("low").collect()) == [0, 1, 2, 3, 4]
    spark.catalog.dropTempView("low")
    assert not spark.catalog.tableExists("middle") and not spark.catalog.tableExists("given")
    assert run_sql_tables(spark, {}) == {}


def test_queries_in_a_circle_are_refused(spark):
    circle = {"a": "SELECT * FROM b", "b": "SELECT * FROM c", "c": "SELECT * FROM a", "d": "SELECT 1 AS x"}
    with pytest.raises(LookupError, match="'a': '`b`'"):
        run_sql_tables(spark, circle)
    with pytest.raises(LookupError, match="nowhere"):
        run_sql_tables(spark, {"a": "SELECT * FROM nowhere"})
    with pytest.raises(LookupError):
        run_sql_tables(spark, {"own": "SELECT * FROM own"})
    with pytest.raises(ValueError):
        run_sql_tables(spark, {"a": "SELECT 1"}, {"a": spark.range(1)})
    with pytest.raises(Exception, match="nothing_like_it"):
        run_sql_tables(spark, {"a": "SELECT nothing_like_it FROM range(2)"})
    spark.range(1).write.mode("overwrite").saveAsTable("taken_name")
    with pytest.raises(ValueError, match="taken_name"):
        run_sql_tables(spark, {"taken_name": "SELECT 1 AS x", "b": "SELECT * FROM taken_name"})
    assert spark.table("taken_name").count() == 1
    spark.sql("DROP TABLE taken_name")


def test_batches_bounded_by_bytes_and_files_archived_once(spark, folder):
    inbox, done = f"{folder}/inbox", f"{folder}/done"
    schema = spark.range(1).schema
    for i in range(8):
        spark.range(i * 100, i * 100 + 100).coalesce(1).write.mode("append").json(inbox)
    one = max(os.path.getsize(f"{inbox}/{f}") for f in os.listdir(inbox) if f.endswith(".json"))
    sizes, seen = [], []

    def store(batch, number):
        sizes.append(len(batch.inputFiles()))
        seen.extend(r.id for r in batch.collect())

    intake = files.Intake(max_bytes=2 * one, archive=done)
    for run in range(3):
        stream = files.stream_json(spark, inbox, schema, intake)
        finish([start(stream, store, f"{folder}/checkpoint")], timeout=200)
        if run == 0:
            spark.range(800, 900).coalesce(1).write.mode("append").json(inbox)
    assert sorted(seen) == list(range(900)) and max(sizes) <= 2 and len(sizes) >= 5
    archived = [f for _, _, names in os.walk(done) for f in names if f.endswith(".json")]
    left = [f for f in os.listdir(inbox) if f.endswith(".json")]
    # A batch's files are moved when the next one begins, each once.
    assert len(archived) + len(left) == 9 and len(set(archived)) == len(archived) >= 6
    with pytest.raises(ValueError):
        files.Intake(max_files=1, max_bytes=1)


SHAPE = (
    T.StructType()
    .add("id", "integer")
    .add("at", T.StructType().add("day", "string").add("n", "double"))
    .add("rows", T.ArrayType(T.StructType().add("k", "integer").add("odd 'name", "string")))
    .add("tags", T.ArrayType(T.IntegerType()))
)
TEXTS = [
    """{"id": 1, "at": {"day": "x", "n": 2}, "rows": [{"k": 1, "odd 'name": "q"}], "tags": [1, 2]}""",
    """{"id": "a", "at": "now", "rows": {"k": 1}, "tags": ["b"], "new": {"id": "z"}}""",
    """{"at": {"n": "two", "zone": null}, "rows": [{"k": "x"}, 5, null, {"more": [1]}], "tags": null}""",
    """{}""", """[1]""", """5""", """null""", """not json""", "", None,
]


def test_declared_fields_of_drifted_documents(spark):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    docs = texts.withColumn("v", drift.as_variant(F.col("t")))
    got = docs.select("i", drift.declared(F.col("v"), SHAPE).alias("d")).orderBy("i").collect()
    found = [r.d and r.d.asDict(recursive=True) for r in got]
    odd = "odd 'name"
    assert found[0] == {"id": 1, "at": {"day": "x", "n": 2.0}, "rows": [{"k": 1, odd: "q"}], "tags": [1, 2]}
    assert found[1]["id"] is None and found[1]["at"] is None and found[1]["rows"] is None
    assert found[2]["rows"] == [{"k": None, odd: None}, None, None, {"k": None, odd: None}]
    assert found[2]["at"] == {"day": None, "n": None}
    assert found[3] == dict.fromkeys(["id", "at", "rows", "tags"])
    assert found[4:] == [None] * 6


def test_drift_reports_what_the_schema_does_not_say(spark):
    texts = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    docs = texts.select(drift.as_variant(F.col("t")).alias("v"), F.lit(1).alias("path"))
    got = [(r.path, r.problem, r.found, r.n) for r in drift.drift(docs, "v", SHAPE).collect()]
    assert sorted(got) == sorted(
        [
            ("id", "type", "STRING", 1),
            ("at", "type", "STRING", 1),
            ("rows", "type", "OBJECT<k: BIGINT>", 1),
            ("rows", "type", "ARRAY<VARIANT>", 1),
            ("tags", "type", "ARRAY<STRING>", 1),
            ("new", "unknown", "OBJECT<id: STRING>", 1),
            ("at.n", "type", "STRING", 1),
            ("at.zone", "unknown", "VOID", 1),
            ("rows[*].k", "type", "STRING", 1),
            ("rows[*].more", "unknown", "ARRAY<BIGINT>", 1),
        ]
    )
    assert drift.drift(docs.where("false"), "v", SHAPE).count() == 0
