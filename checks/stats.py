"""Statistics per entity and appearances from both sides.

Measures are cast to float32 as in the feed: sums of such values are exact in a
double, so the means do not depend on the order of summation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.operators.stats import entity_stats as _entity_stats
from stratafeed.operators.stats import side_counts as _side_counts
from stratafeed.plans.layers import player_stats as _player_stats
from stratafeed.plans.layers import team_counts as _team_counts
from stratafeed.plans.sql_tables import run_sql_table, run_sql_tables
from stratafeed.sources import catalog, files
from stratafeed.sources.storage import new_folder

from .registry import check, table


def line_sides(lines: DataFrame) -> DataFrame:
    return _side_counts(
        lines,
        sides=["l_returnflag", "l_linestatus"],
        dims={"line_no": "l_linenumber"},
        side="flag",
        count="n_lines",
    )


@check("""
    SELECT l_suppkey, l_returnflag, count(DISTINCT l_orderkey) AS n_orders,
           min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
           avg(l_quantity::FLOAT) AS avg_quantity,
           avg(l_extendedprice::FLOAT) AS avg_price,
           avg(l_discount::FLOAT) AS avg_discount,
           avg(l_tax::FLOAT) AS avg_tax
    FROM lineitem GROUP BY l_suppkey, l_returnflag
""")
def entity_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {
            c: F.col(c).cast("float")
            for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        }
    )
    return _entity_stats(
        lines,
        keys=["l_suppkey", "l_returnflag"],
        distinct={"n_orders": "l_orderkey"},
        first={"first_ship": "l_shipdate"},
        last={"last_ship": "l_shipdate"},
        means={
            "avg_quantity": "l_quantity",
            "avg_price": "l_extendedprice",
            "avg_discount": "l_discount",
            "avg_tax": "l_tax",
        },
    )


@check("""
    SELECT event_type, count(DISTINCT user_id) AS n_users, min(ts) AS first_seen,
           max(ts) AS last_seen,
           avg(CASE WHEN event_type <> 'view' OR value > 10
                    THEN value::FLOAT END) AS avg_value
    FROM events GROUP BY event_type
""")
def entity_stats_null_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few hot groups, and a mean that skips nulls."""
    measured = F.when(
        (F.col("event_type") != "view") | (F.col("value") > 10),
        F.col("value").cast("float"),
    )
    return _entity_stats(
        table(spark, sf_dir, "events").withColumn("value", measured),
        keys=["event_type"],
        distinct={"n_users": "user_id"},
        first={"first_seen": "ts"},
        last={"last_seen": "ts"},
        means={"avg_value": "value"},
    )


@check("""
    SELECT l_suppkey AS "PlayerId", l_returnflag AS "MatchName",
           count(DISTINCT l_orderkey) AS "qtGames",
           min(l_shipdate) AS "firstMatch", max(l_shipdate) AS "lastMatch",
           avg(l_extendedprice::FLOAT) AS "avgPoints",
           avg(l_quantity::FLOAT) AS "avgKills",
           avg(l_linenumber::FLOAT) AS "avgAssists",
           avg((l_quantity + l_linenumber)::FLOAT) AS "avgDeaths",
           avg((l_quantity - l_linenumber)::FLOAT) AS "avgHeadshots",
           avg((l_extendedprice / 2)::FLOAT) AS "avgAverageDamagePerRound",
           avg(l_discount::FLOAT) AS "avgKast", avg(l_tax::FLOAT) AS "avgRating"
    FROM lineitem GROUP BY l_suppkey, l_returnflag
""")
def player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player table of the feed, with suppliers as players."""
    measures = {
        "FantasyPoints": F.col("l_extendedprice"),
        "Kills": F.col("l_quantity"),
        "Assists": F.col("l_linenumber"),
        "Deaths": F.col("l_quantity") + F.col("l_linenumber"),
        "Headshots": F.col("l_quantity") - F.col("l_linenumber"),
        "AverageDamagePerRound": F.col("l_extendedprice") / 2,
        "Kast": F.col("l_discount"),
        "Rating": F.col("l_tax"),
    }
    return _player_stats(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_suppkey").alias("PlayerId"),
            F.col("l_returnflag").alias("MatchName"),
            F.col("l_orderkey").alias("GameId"),
            F.col("l_shipdate").alias("DateTime"),
            *[m.cast("float").alias(name) for name, m in measures.items()],
        )
    )


@check("""
    SELECT flag, line_no, count(*) AS n_lines FROM (
        SELECT l_returnflag AS flag, l_linenumber AS line_no FROM lineitem
        UNION ALL
        SELECT l_linestatus, l_linenumber FROM lineitem
    ) GROUP BY flag, line_no
""")
def side_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_sides(table(spark, sf_dir, "lineitem"))


@check("""
    SELECT "TeamName", "MapName", count(*) AS "matchCount" FROM (
        SELECT nullif(l_returnflag, 'N') AS "TeamName", l_linenumber AS "MapName"
        FROM lineitem
        UNION ALL
        SELECT l_linestatus, l_linenumber FROM lineitem
    ) GROUP BY 1, 2
""")
def team_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The team table of the feed, with a null team as one group."""
    return _team_counts(
        table(spark, sf_dir, "lineitem").select(
            F.nullif("l_returnflag", F.lit("N")).alias("TeamAName"),
            F.col("l_linestatus").alias("TeamBName"),
            F.col("l_linenumber").alias("Name"),
        )
    )


_BY_SIDE = """
    SELECT side, o_orderstatus, count(*) AS n_orders FROM (
        SELECT o_orderpriority AS side, o_orderstatus FROM orders
        UNION ALL
        SELECT c_mktsegment AS side, o_orderstatus
        FROM orders JOIN customer ON o_custkey = c_custkey
    ) AS sides
    GROUP BY side, o_orderstatus
"""


@check("SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus")
def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of part files under a name in a database, read by SQL on that name."""
    path = new_folder(spark, "published_table")
    files.append_parquet(table(spark, sf_dir, "orders"), path)
    catalog.ensure_database(spark, "checks_db")
    catalog.publish_folder(spark, "checks_db.published_orders", path)
    if not catalog.table_exists(spark, "checks_db", "published_orders"):
        raise LookupError("checks_db.published_orders")
    return run_sql_table(
        spark,
        "SELECT o_orderstatus, count(*) AS n_orders FROM checks_db.published_orders "
        "GROUP BY o_orderstatus",
    )


@check(_BY_SIDE)
def sql_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table given as SQL text over named frames."""
    views = {name: table(spark, sf_dir, name) for name in ("orders", "customer")}
    return run_sql_table(spark, _BY_SIDE, views)


# Given in an order in which no table can be run: the last one reads no other.
_DEPENDENT = {
    "ranked": """
        SELECT t.o_custkey, t.total, s.c_mktsegment,
               t.total > (SELECT avg(total) FROM per_customer) AS above
        FROM per_customer t JOIN segments s ON s.c_custkey = t.o_custkey
    """,
    "segments": """
        WITH known AS (SELECT c_custkey, c_mktsegment FROM customer)
        SELECT k.* FROM known k LEFT SEMI JOIN per_customer p ON p.o_custkey = k.c_custkey
    """,
    "per_customer": """
        SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total
        FROM orders GROUP BY o_custkey
    """,
}


@check("""
    WITH p AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18, 2)) AS total
               FROM orders GROUP BY o_custkey)
    SELECT c_mktsegment, count(*) AS n_customers,
           count(*) FILTER (total > (SELECT sum(total)::DOUBLE / count(*) FROM p)) AS n_above
    FROM p JOIN customer ON c_custkey = o_custkey GROUP BY c_mktsegment
""")
def sql_tables_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables given by SQL, of which each reads the one below it."""
    views = {name: table(spark, sf_dir, name) for name in ("orders", "customer")}
    ranked = run_sql_tables(spark, _DEPENDENT, views)["ranked"]
    return ranked.groupBy("c_mktsegment").agg(
        F.count("*").alias("n_customers"), F.count_if("above").alias("n_above")
    )
