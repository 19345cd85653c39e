"""Which days to load: orders as the landing feed, by order date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratafeed.operators import days

from .quality import iso_text
from .registry import check, table

DAY = "o_orderdate"
CUT = dt.date(1998, 6, 15)
TODAY = dt.date(1998, 6, 20)


def _landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(spark, sf_dir).where(F.col(DAY) < F.lit(CUT))


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(spark, sf_dir).where(F.col(DAY) >= F.lit(CUT))


def _nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landing(spark, sf_dir).where(F.col(DAY) < F.lit(dt.date(1900, 1, 1)))


def _as_text(found: DataFrame) -> DataFrame:
    return found.select(*[F.col(c).cast("string").alias(c) for c in found.columns])


_FIRST = """
    SELECT * FROM orders WHERE o_orderdate::DATE = (
        SELECT max(o_orderdate::DATE) FROM orders
        WHERE o_orderdate::DATE <= DATE '1998-06-20')
"""


@check(_FIRST)
def days_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No store yet: the newest day that is not after today."""
    return days.select_rows(_landing(spark, sf_dir), None, "new", DAY, TODAY)


@check(_FIRST)
def days_first_empty_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store without rows counts as no store."""
    return days.select_rows(
        _landing(spark, sf_dir), _nothing(spark, sf_dir), "new", DAY, TODAY
    )


@check("""
    SELECT * FROM orders
    WHERE o_orderdate::DATE > (SELECT max(o_orderdate::DATE) FROM orders
                               WHERE o_orderdate < DATE '1998-06-15')
      AND o_orderdate::DATE <= DATE '1998-06-20' + 1
""")
def days_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.select_rows(
        _landing(spark, sf_dir), _stored(spark, sf_dir), "new", DAY, TODAY
    )


@check("""
    SELECT * FROM orders WHERE o_orderdate::DATE IN (
        SELECT DISTINCT o_orderdate::DATE AS d FROM orders
        WHERE o_orderdate::DATE < (SELECT min(o_orderdate::DATE) FROM orders
                                   WHERE o_orderdate >= DATE '1998-06-15')
        ORDER BY d DESC LIMIT 7)
""")
def days_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.select_rows(
        _landing(spark, sf_dir), _recent(spark, sf_dir), "history", DAY, TODAY
    )


_HISTORY_FROM_NOTHING = """
    SELECT * FROM orders WHERE o_orderdate::DATE IN (
        SELECT DISTINCT o_orderdate::DATE AS d FROM orders
        WHERE o_orderdate::DATE <= DATE '1998-06-20' ORDER BY d DESC LIMIT 8)
"""


@check(_HISTORY_FROM_NOTHING)
def days_history_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No store yet: the newest day, and the seven before it."""
    return days.select_rows(_landing(spark, sf_dir), None, "history", DAY, TODAY)


@check(_HISTORY_FROM_NOTHING)
def days_history_empty_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.select_rows(
        _landing(spark, sf_dir), _nothing(spark, sf_dir), "history", DAY, TODAY
    )


@check("SELECT * FROM orders WHERE o_orderdate::DATE = DATE '1998-06-15'")
def days_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.select_rows(
        _landing(spark, sf_dir), None, "date", DAY, d1="1998-06-15"
    )


_RANGE = """
    SELECT {columns} FROM orders
    WHERE o_orderdate::DATE BETWEEN DATE '1998-06-15' AND DATE '1998-06-20'
"""


@check(_RANGE.format(columns="*"))
def days_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days.select_rows(
        _landing(spark, sf_dir), None, "range", DAY, d1="1998-06-15", d2="1998-06-20"
    )


@check(_RANGE.format(columns="o_orderkey, o_totalprice"))
def days_range_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over days kept as ISO text, as the raw feed has them."""
    landing = _landing(spark, sf_dir).withColumn(DAY, iso_text(DAY))
    return days.select_rows(
        landing, None, "range", DAY, d1="1998-06-15", d2="1998-06-20"
    ).select("o_orderkey", "o_totalprice")


def _texts(orders: DataFrame) -> DataFrame:
    return orders.withColumn(DAY, iso_text(DAY))


@check("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate::DATE > (SELECT max(o_orderdate::DATE) FROM orders
                               WHERE o_orderdate < DATE '1998-06-15')
      AND o_orderdate::DATE <= DATE '1998-06-20' + 1
""")
def days_new_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed and what is stored of it have their days as text."""
    landing, stored = _texts(_landing(spark, sf_dir)), _texts(_stored(spark, sf_dir))
    found = days.select_rows(landing, stored, "new", DAY, TODAY)
    return found.select("o_orderkey", "o_totalprice")


@check("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate::DATE IN (
        SELECT DISTINCT o_orderdate::DATE AS d FROM orders
        WHERE o_orderdate::DATE < (SELECT min(o_orderdate::DATE) FROM orders
                                   WHERE o_orderdate >= DATE '1998-06-15')
        ORDER BY d DESC LIMIT 7)
""")
def days_history_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range is found once and then used as two dates."""
    landing, stored = _texts(_landing(spark, sf_dir)), _texts(_recent(spark, sf_dir))
    found = days.find_range(landing, stored, "history", DAY, TODAY) or (TODAY, TODAY)
    return days.rows_between(landing, DAY, *found).select("o_orderkey", "o_totalprice")


@check("""
    SELECT DISTINCT o_orderdate::DATE::VARCHAR AS day FROM orders
    WHERE o_orderdate >= DATE '1998-06-15'
      AND o_orderdate::DATE <= DATE '1998-06-20' + 1
""")
def days_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = days.select_days(
        _landing(spark, sf_dir), _stored(spark, sf_dir), "new", DAY, TODAY
    )
    return _as_text(listed)


@check("""
    SELECT min(o_orderdate)::DATE::VARCHAR AS min_day,
           max(o_orderdate)::DATE::VARCHAR AS max_day
    FROM orders
""")
def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(days.frontier(_landing(spark, sf_dir), DAY))


def _malformed(orders: DataFrame) -> DataFrame:
    """Days as text, but for urgent orders, whose texts are no days and sort around them."""
    kind = F.col("o_orderkey") % 4
    broken = F.when(kind == 0, "n/a").when(kind == 1, "").when(kind == 2, "1899").otherwise("9999-99-99")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return orders.withColumn(DAY, F.when(urgent, broken).otherwise(iso_text(DAY)))


_CALM = "(SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT')"


@check(f"""
    SELECT o_orderkey, o_totalprice FROM {_CALM}
    WHERE o_orderdate::DATE > (SELECT max(o_orderdate::DATE) FROM {_CALM}
                               WHERE o_orderdate < DATE '1998-06-15')
      AND o_orderdate::DATE <= DATE '1998-06-20' + 1
""")
def days_new_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are no days, in the feed and in what is stored of it."""
    landing, stored = _malformed(_landing(spark, sf_dir)), _malformed(_stored(spark, sf_dir))
    found = days.select_rows(landing, stored, "new", DAY, TODAY)
    return found.select("o_orderkey", "o_totalprice")


@check(f"""
    SELECT min(o_orderdate)::DATE::VARCHAR AS min_day,
           max(o_orderdate)::DATE::VARCHAR AS max_day
    FROM {_CALM}
""")
def frontier_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(days.frontier(_malformed(_landing(spark, sf_dir)), DAY))


@check(f"""
    SELECT d::DATE::VARCHAR AS day
    FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP,
                                        max(o_orderdate)::DATE::TIMESTAMP,
                                        INTERVAL 1 DAY)) AS d FROM {_CALM})
    WHERE d::DATE NOT IN (SELECT o_orderdate::DATE FROM {_CALM})
""")
def calendar_gaps_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(days.calendar_gaps(_malformed(_landing(spark, sf_dir)), DAY))


@check("""
    SELECT d::DATE::VARCHAR AS day
    FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP,
                                        max(o_orderdate)::DATE::TIMESTAMP,
                                        INTERVAL 1 DAY)) AS d FROM orders)
    WHERE d::DATE NOT IN (SELECT o_orderdate::DATE FROM orders)
""")
def calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_text(days.calendar_gaps(_landing(spark, sf_dir), DAY))
