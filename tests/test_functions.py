from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratafeed.functions import (
    as_day,
    conform,
    mark_valid,
    normalise_iso,
    split_valid,
    strict_day,
    valid_date_text,
)
from stratafeed.schemas import MATCH_SCHEMA


@pytest.mark.parametrize(
    ("text", "strict", "kept"),
    [
        ("2023-01-05T10:11:12",) + (dt.datetime(2023, 1, 5, 10, 11, 12),) * 2,
        ("2023-01-05 10:11:12",) + (dt.datetime(2023, 1, 5, 10, 11, 12),) * 2,
        ("2023-01-05T10:11:12.123", None, dt.datetime(2023, 1, 5, 10, 11, 12, 123000)),
        # An hour that New York, the session time zone of the tests, skips.
        ("2024-03-10T02:30:00",) + (dt.datetime(2024, 3, 10, 2, 30),) * 2,
        ("2023-02-30T00:00:00", None, None),
        ("2023-01-05T24:00:00", None, None),
        ("2023-01-05", None, None),
        ("2023-1-5T00:00:00", None, None),
        ("", None, None),
        ("yesterday", None, None),
        (None, None, None),
    ],
)
def test_normalise_iso(spark, text, strict, kept):
    df = spark.createDataFrame([(text, text)], "a string, b string")
    df = normalise_iso(normalise_iso(df, ["a"]), ["b"], keep_fraction=True)
    assert df.dtypes == [("a", "timestamp_ntz"), ("b", "timestamp_ntz")]
    assert tuple(df.first()) == (strict, kept)


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        ("2023-01-05", True),
        ("2024-02-29", True),
        ("2023-02-29", False),
        ("2023-1-5", False),
        ("2023-01-05T00:00:00", False),
        ("2023-13-01", False),
        ("", False),
        (None, False),
    ],
)
def test_valid_date_text(spark, text, valid):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        valid_date_text(F.col("t")).alias("v"), strict_day(F.col("t")).alias("d")
    ).first()
    assert row.v is valid
    assert (row.d is not None) is valid


def test_as_day(spark):
    df = spark.sql(
        "SELECT '2023-01-05T10:00:00' AS a, DATE '2023-01-05' AS b, "
        "TIMESTAMP_NTZ '2023-01-05 23:59:59' AS c, 'x' AS d"
    )
    row = df.select(*[as_day(F.col(c)).alias(c) for c in df.columns]).first()
    assert tuple(row) == (dt.date(2023, 1, 5),) * 3 + (None,)


def test_split_valid_keeps_every_row(spark):
    df = spark.createDataFrame(
        [(1, "a"), (None, "b"), (3, None), (None, None)], "k int, v string"
    )
    good, rejected = split_valid(df, ["k", "v"])
    assert [tuple(r) for r in good.collect()] == [(1, "a")]
    assert good.count() + rejected.count() == df.count()
    assert {r.is_valid for r in mark_valid(df, ["k"]).collect()} == {True, False}
    assert split_valid(df, [])[0].count() == 4


def test_declared_types_take_json_numbers(spark, folder):
    """1.5 fits the point spread, an unknown key is dropped, a null stays null."""
    with open(f"{folder}/m.json", "w") as file:
        file.write('{"GameId": 1, "PointSpread": 1.5, "BestOf": 3, "Extra": 1}\n')
    row = spark.read.schema(MATCH_SCHEMA).json(folder).first()
    assert (row.GameId, str(row.PointSpread), row.BestOf) == (1, "1.50", "3")
    assert row.Status is None
    assert "Extra" not in row.asDict()


def test_conform_orders_declared_fields(spark):
    df = spark.createDataFrame([(1, 2, 3)], "c int, b int, a int")
    schema = spark.createDataFrame([], "a int, c int").schema
    assert conform(df, schema).columns == ["a", "c"]
