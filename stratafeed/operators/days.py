"""Which days of a landing feed still have to be loaded.

Every mode comes down to one half-open range of days ``[lo, hi)``. Its ends are
scalar subqueries over the two tables, so nothing is collected, and the rows are
taken with a plain range predicate that reaches the file scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from enum import StrEnum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import ISO_START, as_day

# Fixed value: non-empty days that one run of the history mode goes back.
HISTORY_DAYS = 7


class Mode(StrEnum):
    NEW = "new"
    HISTORY = "history"
    DATE = "date"
    RANGE = "range"


@dataclass(frozen=True)
class _Bounds:
    """Ends of the range, each a one-row, one-column frame of dates or a literal."""

    lo: DataFrame | dt.date
    hi: DataFrame | dt.date


def select_days(
    landing: DataFrame,
    stored: DataFrame | None,
    mode: str,
    day: str,
    today: dt.date | None = None,
    d1: str | dt.date | None = None,
    d2: str | dt.date | None = None,
) -> DataFrame:
    """The distinct days that ``select_rows`` would load, as one column ``day``."""
    rows = select_rows(landing.select(day), stored, mode, day, today, d1, d2)
    return rows.select(as_day(F.col(day)).alias("day")).distinct()


def select_rows(
    landing: DataFrame,
    stored: DataFrame | None,
    mode: str,
    day: str,
    today: dt.date | None = None,
    d1: str | dt.date | None = None,
    d2: str | dt.date | None = None,
) -> DataFrame:
    """Rows of the days to load, given what is already stored.

    * ``new``: after the newest stored day, up to and including the day after
      ``today``. With nothing stored: the newest day that is not after ``today``.
    * ``history``: the seven newest days before the oldest stored one. With
      nothing stored: the day ``new`` would take, and the seven before it.
    * ``date``: the day ``d1``.
    * ``range``: from ``d1`` to ``d2``, both included; ``d1`` must be the earlier.

    Only days that have rows count, so ``history`` ends when history does. ``day``
    may be a date, a zone-free timestamp or ISO text (``yyyy-MM-dd``, with or without
    a time); other text belongs to no day.
    """
    bounds = _bounds(landing, stored, mode, day, today, d1, d2)
    return landing.where(_within(landing, day, bounds.lo, bounds.hi))


def find_range(
    landing: DataFrame,
    stored: DataFrame | None,
    mode: str,
    day: str,
    today: dt.date | None = None,
    d1: str | dt.date | None = None,
    d2: str | dt.date | None = None,
) -> tuple[dt.date, dt.date] | None:
    """The range ``[lo, hi)`` of ``select_rows`` as two dates, for several uses of it.

    None if there is no day to load. The day column of the landing feed is read once:
    its distinct days are kept while the ends are found among them.
    """
    if mode in (Mode.DATE, Mode.RANGE):
        bounds = _bounds(landing, stored, mode, day, today, d1, d2)
        return bounds.lo, bounds.hi
    listed = landing.select(day_of(landing, day).alias(day)).distinct().persist()
    try:
        bounds = _bounds(listed, stored, mode, day, today)
        lo, hi = (_end(end, T.DateType()) for end in (bounds.lo, bounds.hi))
        row = landing.sparkSession.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    finally:
        listed.unpersist()
    return None if row.lo is None or row.hi is None else (row.lo, row.hi)


def rows_between(landing: DataFrame, day: str, lo: dt.date, hi: dt.date) -> DataFrame:
    """Rows from ``lo`` up to, but not including, ``hi``."""
    return landing.where(_within(landing, day, lo, hi))


def _bounds(
    landing: DataFrame,
    stored: DataFrame | None,
    mode: str,
    day: str,
    today: dt.date | None,
    d1: str | dt.date | None = None,
    d2: str | dt.date | None = None,
) -> _Bounds:
    match Mode(mode):
        case Mode.NEW:
            return _new(landing, stored, day, today or _today())
        case Mode.HISTORY:
            return _history(landing, stored, day, today or _today())
        case Mode.DATE:
            first = _parse(d1)
            return _Bounds(first, _next(first))
        case Mode.RANGE:
            first, last = _parse(d1), _parse(d2)
            if not first < last:
                raise ValueError(f"the range {first} to {last} is not in order")
            return _Bounds(first, _next(last))


def day_of(df: DataFrame, day: str) -> Column:
    """The day of a row; null for text that does not begin with one."""
    column = F.col(day)
    if isinstance(df.schema[day].dataType, T.StringType):
        column = F.when(column.rlike(ISO_START), column)
    return as_day(column)


def frontier(df: DataFrame, day: str) -> DataFrame:
    """Oldest and newest day, as one row ``(min_day, max_day)``.

    Texts are parsed before they are compared, so one that is no day never stands for
    the oldest or newest. Typed days are compared as they are stored, which a reader
    may answer from the statistics of its files.
    """
    if isinstance(df.schema[day].dataType, T.StringType):
        own = day_of(df, day)
        return df.agg(F.min(own).alias("min_day"), F.max(own).alias("max_day"))
    return df.agg(
        as_day(F.min(day)).alias("min_day"), as_day(F.max(day)).alias("max_day")
    )


def calendar_gaps(df: DataFrame, day: str) -> DataFrame:
    """Calendar days between the oldest and the newest one that have no rows."""
    calendar = frontier(df, day).select(
        F.explode(F.sequence("min_day", "max_day")).alias("day")
    )
    present = df.select(day_of(df, day).alias("day")).distinct()
    return calendar.join(present, "day", "left_anti")


def _new(
    landing: DataFrame, stored: DataFrame | None, day: str, today: dt.date
) -> _Bounds:
    first = _newest_until(landing, day, today)
    if stored is None:
        return _Bounds(first, _shift(first, 1))
    newest = frontier(stored, day).select(F.col("max_day").alias("d"))
    return _Bounds(
        lo=newest.select(F.coalesce(F.date_add("d", 1), first.scalar()).alias("d")),
        hi=newest.select(
            F.when(F.col("d").isNull(), _shift(first, 1).scalar())
            .otherwise(F.lit(today + dt.timedelta(days=2)))
            .alias("d")
        ),
    )


def _history(
    landing: DataFrame, stored: DataFrame | None, day: str, today: dt.date
) -> _Bounds:
    # With nothing stored the starting day is loaded too, one day on top.
    start = _shift(_newest_until(landing, day, today), 1)
    from_start = _nth_newest_before(landing, day, start, HISTORY_DAYS + 1)
    if stored is None:
        return _Bounds(from_start, start)
    oldest = frontier(stored, day).select(F.col("min_day").alias("d"))
    from_oldest = _nth_newest_before(landing, day, oldest, HISTORY_DAYS)
    return _Bounds(
        lo=oldest.select(
            F.when(F.col("d").isNull(), from_start.scalar())
            .otherwise(from_oldest.scalar())
            .alias("d")
        ),
        hi=oldest.select(F.coalesce("d", start.scalar()).alias("d")),
    )


def _newest_until(landing: DataFrame, day: str, today: dt.date) -> DataFrame:
    upto = landing.where(_within(landing, day, None, _next(today)))
    return frontier(upto, day).select(F.col("max_day").alias("d"))


def _nth_newest_before(
    landing: DataFrame, day: str, before: DataFrame, n: int
) -> DataFrame:
    """The oldest of the ``n`` newest days with rows before ``before``."""
    newest = (
        landing.where(_within(landing, day, None, before))
        .select(as_day(F.col(day)).alias("d"))
        .distinct()
        .orderBy(F.col("d").desc())
        .limit(n)
    )
    return newest.agg(F.min("d").alias("d"))


def _shift(one_day: DataFrame, days: int) -> DataFrame:
    return one_day.select(F.date_add("d", days).alias("d"))


def _within(
    df: DataFrame, day: str, lo: DataFrame | dt.date | None, hi: DataFrame | dt.date
) -> Column:
    """Whether a row's day is in ``[lo, hi)``.

    The bare column is compared, so that the predicate can be pushed into the scan; ISO
    text sorts as its days do, so it is compared with the text of the ends.
    """
    column, dtype = F.col(day), df.schema[day].dataType
    inside = column < _end(hi, dtype)
    if lo is not None:
        inside = (column >= _end(lo, dtype)) & inside
    if isinstance(dtype, T.StringType):
        inside = inside & column.rlike(ISO_START) & as_day(column).isNotNull()
    return inside


def _end(bound: DataFrame | dt.date, dtype: T.DataType) -> Column:
    if isinstance(bound, DataFrame):
        return bound.select(F.col("d").cast(dtype)).scalar()
    return F.lit(bound).cast(dtype)


def _parse(text: str | dt.date | None) -> dt.date:
    if isinstance(text, dt.date):
        return text
    if text is None:
        raise ValueError("this mode needs a date")
    return dt.datetime.strptime(text, "%Y-%m-%d").date()


def _next(day: dt.date) -> dt.date:
    return day + dt.timedelta(days=1)


def _today() -> dt.date:
    return dt.date.today()
