"""ISO text to typed dates and timestamps.

Everything here is a built-in column expression. Text that does not parse gives
null under ANSI mode too, because only the ``try_`` forms are used.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text accepted for a timestamp, for a day, for either by its start,
# and for a timestamp with a fraction.
ISO_SECONDS = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}\z"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}\z"
ISO_START = r"^\d{4}-\d{2}-\d{2}([T ]|\z)"
ISO_FRACTION = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?\z"


def normalise_iso(
    df: DataFrame, columns: Iterable[str], keep_fraction: bool = False
) -> DataFrame:
    """Replace ISO text columns by zone-free timestamps.

    The cast goes straight to ``timestamp_ntz``, so a wall-clock time that the
    session time zone skips (a daylight-saving gap) keeps its value. Text with a
    fraction of a second is null unless ``keep_fraction`` is set.
    """
    pattern = ISO_FRACTION if keep_fraction else ISO_SECONDS
    return df.withColumns(
        {
            c: F.when(F.col(c).rlike(pattern), F.col(c).try_cast("timestamp_ntz"))
            for c in columns
        }
    )


def strict_day(text: Column) -> Column:
    """The date of ``yyyy-MM-dd`` text, null unless written with two-digit parts."""
    return F.when(text.rlike(ISO_DAY), text.try_cast(T.DateType()))


def valid_date_text(text: Column) -> Column:
    """True where the text is a real ``yyyy-MM-dd`` date; null text is false."""
    return strict_day(text).isNotNull()


def as_day(column: Column) -> Column:
    """Date part of a date, timestamp or ISO text column."""
    return column.try_cast(T.DateType())
