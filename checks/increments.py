"""Feeds kept by day and loaded again, and statistics kept up by increments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.operators.increments import (
    Measures,
    of_keys,
    totals,
    without_keys,
)
from stratafeed.plans import layers
from stratafeed.schemas import MATCH_SCHEMA, MATCHES
from stratafeed.sources import files
from stratafeed.sources.partials import refresh_partials
from stratafeed.sources.storage import new_folder

from .pipeline import match_rows
from .registry import check, table

# Two loads that overlap by half a year and together hold every day.
FIRST, SECOND = ("1900-01-01", "1997-12-31"), ("1997-07-01", "2100-01-01")
SHOWN = ["GameId", "Day", "Season"]


def _loaded(spark: SparkSession, sf_dir: str, name: str, corrected: bool = False) -> str:
    """Two overlapping loads of the raw match feed, the second one run twice."""
    lake = layers.Lake(new_folder(spark, name))
    landing = match_rows(spark, sf_dir)
    layers.load_matches(spark, lake, landing, "range", d1=FIRST[0], d2=FIRST[1])
    if corrected:
        landing = landing.withColumn("Season", F.col("Season") + 1000)
    for _ in range(2):
        layers.load_matches(spark, lake, landing, "range", d1=SECOND[0], d2=SECOND[1])
    return lake.raw(MATCHES.name)


def _raw(spark: SparkSession, path: str) -> DataFrame:
    return files.read_days(spark, path, MATCH_SCHEMA)


_MATCHES = """
    SELECT o_orderkey::INTEGER AS "GameId",
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "Day",
           (year(o_orderdate){more})::INTEGER AS "Season"
    FROM orders
"""


@check(_MATCHES.format(more=""))
def raw_days_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that are loaded several times are stored once."""
    return _raw(spark, _loaded(spark, sf_dir, "raw_days_reloaded")).select(*SHOWN)


@check(
    _MATCHES.format(
        more=" + CASE WHEN o_orderdate >= DATE '1997-07-01' THEN 1000 ELSE 0 END"
    )
)
def raw_days_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later load replaces the rows of its days, and of no other."""
    path = _loaded(spark, sf_dir, "raw_days_corrected", corrected=True)
    return _raw(spark, path).select(*SHOWN)


@check("""
    SELECT o_orderkey::INTEGER AS "GameId", o_orderdate::DATE::VARCHAR AS day
    FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-06-15' AND DATE '1998-06-20'
""")
def raw_days_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of days, of which only the folders are read."""
    raw = _raw(spark, _loaded(spark, sf_dir, "raw_days_pruned"))
    lo, hi = dt.date(1998, 6, 15), dt.date(1998, 6, 20)
    chosen = raw.where(F.col(files.DAY_FOLDER).between(F.lit(lo), F.lit(hi)))
    return chosen.select("GameId", F.col(files.DAY_FOLDER).cast("string").alias("day"))


@check("""
    SELECT min(o_orderdate)::DATE::VARCHAR AS min_day,
           max(o_orderdate)::DATE::VARCHAR AS max_day, count(DISTINCT o_orderdate::DATE) AS n_days
    FROM orders
""")
def raw_days_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oldest and newest stored day and their number, from names of folders alone."""
    days = files.stored_days(spark, _loaded(spark, sf_dir, "raw_days_stored"), "Day")
    return days.agg(
        F.min("Day").cast("string").alias("min_day"),
        F.max("Day").cast("string").alias("max_day"),
        F.count("Day").alias("n_days"),
    )


@check("""
    SELECT min(l_shipdate)::DATE::VARCHAR AS min_day,
           max(l_shipdate)::DATE::VARCHAR AS max_day
    FROM lineitem
""")
def frontier_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oldest and newest day of files with a date column, from their footers."""
    path = new_folder(spark, "frontier_footers")
    lines = table(spark, sf_dir, "lineitem")
    files.append_parquet(lines.select("l_orderkey", F.to_date("l_shipdate").alias("day")), path)
    days = [str(day) for day in files.day_bounds(spark, path, "day")]
    return spark.range(1).select(F.lit(days[0]).alias("min_day"), F.lit(days[1]).alias("max_day"))


# Rows that come late are older; corrections move lines to another supplier and raise
# their quantity, or take them back.
LATE = "l_shipdate < DATE '1995-01-01'"
MOVED, GONE = "l_returnflag = 'R'", "l_returnflag = 'A' AND l_linenumber = 1"
CORRECTED = f"""
    SELECT CASE WHEN {MOVED} THEN l_suppkey % 7 ELSE l_suppkey END AS l_suppkey,
           l_orderkey, l_linenumber, l_linestatus, l_returnflag, l_shipdate,
           (l_quantity + CASE WHEN {MOVED} THEN 1 ELSE 0 END)::FLOAT AS l_quantity,
           l_extendedprice::FLOAT AS l_extendedprice
    FROM lineitem WHERE NOT ({GONE})
"""


def _versions(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, str]]:
    """Current lines after each step, and what tells the lines that the step touched."""
    lines = table(spark, sf_dir, "lineitem")
    floats = {c: F.col(c).cast("float") for c in ("l_quantity", "l_extendedprice")}
    moved = F.expr(MOVED)
    corrected = lines.where(~F.expr(GONE)).withColumns(
        {
            "l_suppkey": F.when(moved, F.col("l_suppkey") % 7).otherwise(F.col("l_suppkey")),
            "l_quantity": F.col("l_quantity") + F.when(moved, 1).otherwise(0),
        }
    )
    return [
        (lines.where(f"NOT ({LATE})").withColumns(floats), f"NOT ({LATE})"),
        (lines.withColumns(floats), LATE),
        (corrected.withColumns(floats), f"({MOVED}) OR ({GONE})"),
    ]


def _kept_up(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    measures: Measures,
    rows: Callable[[DataFrame], DataFrame] = lambda lines: lines,
) -> DataFrame:
    """Statistics after three changes, of which each only touches some orders."""
    root, stats = new_folder(spark, name), None
    for number, (current, touched) in enumerate(_versions(spark, sf_dir)):
        changed = table(spark, sf_dir, "lineitem").where(touched).select("l_orderkey")
        # The last change is made twice, as after a failure.
        for again in range(2 if number == 2 else 1):
            found = refresh_partials(
                spark, f"{root}/partials", f"{root}/work-{number}", rows(current), changed,
                measures, buckets=4,
            )
            if found is None:
                continue
            fresh = totals(of_keys(*found, measures), measures)
            if stats is not None:
                fresh = without_keys(stats, found[1], measures).unionByName(fresh)
            folder = f"{root}/stats-{number}-{again}"
            fresh.write.parquet(folder)
            stats = spark.read.schema(fresh.schema).parquet(folder)
    return stats


@check(f"""
    SELECT l_suppkey, l_linestatus, count(DISTINCT l_orderkey) AS n_orders,
           count(*) AS n_lines, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
           avg(l_quantity) AS avg_quantity, avg(l_extendedprice) AS avg_price
    FROM ({CORRECTED}) GROUP BY l_suppkey, l_linestatus
""")
def stats_by_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After late, corrected and withdrawn rows the same as computed from all rows."""
    measures = Measures(
        ("l_suppkey", "l_linestatus"),
        "l_orderkey",
        parts="n_orders",
        rows="n_lines",
        first={"first_ship": "l_shipdate"},
        last={"last_ship": "l_shipdate"},
        means={"avg_quantity": "l_quantity", "avg_price": "l_extendedprice"},
    )
    return _kept_up(spark, sf_dir, "stats_by_increments", measures)


@check(f"""
    SELECT flag, l_linenumber, count(*) AS n_lines FROM (
        SELECT unnest([l_returnflag, l_linestatus]) AS flag, l_linenumber FROM ({CORRECTED}))
    GROUP BY flag, l_linenumber
""")
def counts_by_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for appearances on either side, where a few keys hold all rows."""

    def sides(lines: DataFrame) -> DataFrame:
        flags = F.explode(F.array("l_returnflag", "l_linestatus")).alias("flag")
        return lines.select(flags, "l_linenumber", "l_orderkey")

    measures = Measures(("flag", "l_linenumber"), "l_orderkey", rows="n_lines")
    return _kept_up(spark, sf_dir, "counts_by_increments", measures, sides)
