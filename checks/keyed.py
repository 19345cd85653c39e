"""Latest versions, pending work and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.operators import backlog, dedup, merge
from stratafeed.schemas import TableSpec
from stratafeed.sources import keyed as tables
from stratafeed.sources.storage import new_folder

from .registry import check, table
from .stats import line_sides

KEYS = ["user_id", "event_type"]
STORED_UNTIL = "2024-01-20"
BATCH_FROM = "2024-01-10"

LATEST = """
    SELECT {columns} FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE {where}
    ) WHERE rn = 1
"""
ALL_COLUMNS = "event_id, ts, user_id, event_type, value, props"
EARLY = f"ts < TIMESTAMP '{STORED_UNTIL}'"
LATE = f"ts >= TIMESTAMP '{BATCH_FROM}'"


def latest_sql(where: str = "true") -> str:
    return LATEST.format(columns=ALL_COLUMNS, where=where)


def latest_events(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    events = table(spark, sf_dir, "events")
    return dedup.latest_version(events, KEYS, "ts", ["event_id"], where)


@check(latest_sql("event_type <> 'error'"))
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_events(spark, sf_dir, "event_type <> 'error'")


@check("""
    SELECT event_id, user_id, version FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY version DESC NULLS LAST, event_id DESC) AS rn
        FROM (SELECT event_id, user_id,
                     CASE WHEN value > 5 THEN ts END AS version FROM events)
    ) WHERE rn = 1
""")
def latest_version_null_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.when(F.col("value") > 5, F.col("ts")).alias("version")
    )
    return dedup.latest_version(rows, ["user_id"], "version", ["event_id"])


@check("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC,
                     l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                     l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
        FROM lineitem
    ) WHERE rn = 1
""")
def latest_version_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties decided by the remaining columns, the default."""
    lines = table(spark, sf_dir, "lineitem")
    return dedup.latest_version(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@check("""
    SELECT event_type, event_id, ts FROM (
        SELECT *, row_number() OVER (
            PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn
        FROM events
    ) WHERE rn = 1
""")
def latest_version_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five keys for the whole table."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return dedup.latest_version(events, ["event_type"], "ts", ["event_id"])


@check("""
    SELECT DISTINCT o_orderkey AS order_id FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def pending_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "order_id")
    done = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_id")
    return backlog.pending(work, done, ["order_id"])


@check("""
    SELECT doc_id FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def pending_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    return backlog.pending(documents, labels, ["doc_id"])


@check("SELECT DISTINCT o_orderkey FROM orders")
def pending_nothing_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.pending(table(spark, sf_dir, "orders"), None, ["o_orderkey"])


@check("""
    SELECT DISTINCT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey::VARCHAR
                         ELSE 'no id' END AS order_id
    FROM orders
    WHERE o_orderstatus = 'P'
       OR NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def pending_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null ids match nothing and stay pending, as one row."""
    work = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_id")
    )
    done = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_id")
    open_ids = backlog.pending(work, done, ["order_id"])
    return open_ids.select(
        F.coalesce(F.col("order_id").cast("string"), F.lit("no id")).alias("order_id")
    )


@check("""
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def pending_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars"
    )
    return backlog.only_pending(documents, table(spark, sf_dir, "labels"), ["doc_id"])


def _merged_sql(stored: str, batch: str) -> str:
    """The batch wins every key it holds."""
    columns = ", ".join(f"coalesce(b.{c}, s.{c}) AS {c}" for c in ALL_COLUMNS.split(", "))
    return f"""
        SELECT {columns}
        FROM ({latest_sql(stored)}) AS s FULL OUTER JOIN ({latest_sql(batch)}) AS b
          ON s.user_id = b.user_id AND s.event_type = b.event_type
    """


@check(_merged_sql(stored=LATE, batch=EARLY))
def upsert_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a version the batch wins, though its rows are the older ones."""
    stored = latest_events(spark, sf_dir, LATE)
    return merge.upsert(stored, latest_events(spark, sf_dir, EARLY), KEYS, unique=True)


@check(latest_sql())
def upsert_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch with a version: older rows do not replace newer ones."""
    stored = latest_events(spark, sf_dir, LATE)
    batch = latest_events(spark, sf_dir, EARLY)
    return merge.upsert(stored, batch, KEYS, version="ts", unique=True)


@check("""
    SELECT s.user_id, s.event_type,
           CASE WHEN b.user_id IS NOT NULL AND (s.version IS NULL
                     OR b.version >= s.version) THEN 'batch' ELSE 'stored' END AS origin
    FROM (SELECT user_id, event_type,
                 max(CASE WHEN value > 5 THEN date_trunc('day', ts) END) AS version
          FROM events GROUP BY ALL) AS s
    LEFT JOIN (SELECT user_id, event_type,
                      max(CASE WHEN value <= 15 THEN date_trunc('day', ts) END) AS version
               FROM events GROUP BY ALL) AS b
      ON s.user_id = b.user_id AND s.event_type = b.event_type
""")
def upsert_version_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal versions go to the batch; a null version is older than any other."""
    events = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))

    def newest(origin: str, condition: str) -> DataFrame:
        return events.groupBy(*KEYS).agg(
            F.max(F.expr(f"CASE WHEN {condition} THEN d END")).alias("version"),
            F.lit(origin).alias("origin"),
        )

    stored, batch = newest("stored", "value > 5"), newest("batch", "value <= 15")
    merged = merge.upsert(stored, batch, KEYS, version="version", unique=True)
    return merged.drop("version")


@check(latest_sql())
def upsert_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Into an empty table."""
    batch = latest_events(spark, sf_dir)
    return merge.upsert(spark.createDataFrame([], batch.schema), batch, KEYS, unique=True)


def _line_sides_sql(where: str) -> str:
    return f"""
        SELECT flag, line_no, count(*) AS n_lines FROM (
            SELECT l_returnflag AS flag, l_linenumber AS line_no
            FROM lineitem WHERE {where}
            UNION ALL
            SELECT l_linestatus, l_linenumber FROM lineitem WHERE {where}
        ) GROUP BY flag, line_no
    """


@check(f"""
    SELECT coalesce(b.flag, s.flag) AS flag, coalesce(b.line_no, s.line_no) AS line_no,
           coalesce(b.n_lines, s.n_lines) AS n_lines
    FROM ({_line_sides_sql("l_linestatus = 'F'")}) AS s
    FULL OUTER JOIN ({_line_sides_sql("l_returnflag = 'N'")}) AS b
      ON s.flag = b.flag AND s.line_no = b.line_no
""")
def upsert_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts of closed lines, updated by those of unreturned ones."""
    lines = table(spark, sf_dir, "lineitem")
    return merge.upsert(
        line_sides(lines.where("l_linestatus = 'F'")),
        line_sides(lines.where("l_returnflag = 'N'")),
        ["flag", "line_no"],
    )


@check("""
    SELECT nullif(event_type, 'error') AS kind, count(*) AS n FROM events GROUP BY 1
""")
def upsert_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group with a null key is updated, not inserted again."""
    stored, batch = _null_groups(spark, sf_dir)
    return merge.upsert(stored, batch, ["kind"], null_safe=True)


@check(f"""
    SELECT nullif(event_type, 'error') AS kind, count(*) AS n FROM events GROUP BY 1
    UNION ALL
    SELECT NULL, count(*) FROM events WHERE event_type = 'error' AND {EARLY}
""")
def upsert_null_keys_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With plain equality the null group is there twice."""
    stored, batch = _null_groups(spark, sf_dir)
    return merge.upsert(stored, batch, ["kind"])


def _null_groups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events").withColumn(
        "kind", F.nullif("event_type", F.lit("error"))
    )

    def counts(rows: DataFrame) -> DataFrame:
        return rows.groupBy("kind").agg(F.count("*").alias("n"))

    return counts(events.where(EARLY)), counts(events)


_OPEN_LINES = "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_linestatus = 'O'"


@check(f"""
    SELECT l_orderkey, l_linenumber, count(*) AS source_rows FROM lineitem
    WHERE (l_orderkey, l_linenumber) IN ({_OPEN_LINES})
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def ambiguous_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return merge.ambiguous_matches(
        lines.where("l_linestatus = 'O'"), lines, ["l_orderkey", "l_linenumber"]
    )


@check(latest_sql())
def keyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table: batches in any order, folded into a base, one more after."""
    events = table(spark, sf_dir, "events")
    spec = TableSpec("events", events.schema, tuple(KEYS), "ts", ("event_id",))
    path = new_folder(spark, "keyed_table")
    middle = f"({EARLY} AND {LATE})"
    for number, where in enumerate([LATE, f"NOT {LATE}", middle]):
        batch = latest_events(spark, sf_dir, where)
        tables.write_increment(batch, path, number)
        if number == 1:
            tables.compact(spark, path, spec)
    return tables.read_current(spark, path, spec)


@check("""
    SELECT event_type, count(*) AS n, max(ts) AS last_seen FROM events GROUP BY 1
""")
def keyed_table_recomputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of statistics, merged with its own recomputation."""
    path = new_folder(spark, "keyed_table_recomputed")
    events = table(spark, sf_dir, "events")
    for where in (EARLY, "true"):
        rows = (
            events.where(where)
            .groupBy("event_type")
            .agg(F.count("*").alias("n"), F.max("ts").alias("last_seen"))
        )
        spec = TableSpec("by_type", rows.schema, ("event_type",))
        tables.upsert_table(spark, path, spec, rows)
    return tables.read_current(spark, path, spec)


@check(latest_sql())
def upsert_repeated_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that holds every version of its keys, onto the earlier ones."""
    events = table(spark, sf_dir, "events")
    return merge.upsert(latest_events(spark, sf_dir, EARLY), events, KEYS, version="ts")
