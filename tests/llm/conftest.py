from __future__ import annotations

import pytest

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use for columns of their own.
        T.StructField("size", T.LongType()),
        T.StructField("node", T.StringType()),
        T.StructField("n_words", T.LongType()),
    ]
)
PROSE = " ".join(f"word{i % 97} goes{i % 31} on{i}" for i in range(60))
ODD = [
    (1, PROSE, "en", "a", 5, "x", 1),
    (2, PROSE + " end", "en", "a", None, None, None),
    (2, PROSE + " end", "en", "a", None, None, None),
    (3, None, None, None, 1, "x", 1),
    (None, "A b c", "de", "b", 1, "x", 1),
    (None, None, None, None, None, None, None),
    (4, "", "de", "b", 1, "x", 1),
    (5, " \n\t ", "de", "b", 1, "x", 1),
    (6, "über " * 20_000 + "\n" + "x" * 3000, "de", "b", 1, "x", 1),
    (7, PROSE.upper(), "fr", "a", 1, "x", 1),
    (8, "a b c", "fr", None, 1, "x", 1),
    (9, "0\x00é日本 🎉 >>> ### 12 !?", "fr", "c", 1, "x", 1),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
