"""Every registered query against its SQL twin, at the smallest size."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from checks import CHECKS

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", list(CHECKS))
def test_agrees_with_sql(spark, duck, name):
    check = CHECKS[name]
    result = check.run(spark, str(SF_DIR))
    twin = duck.sql(check.sql)
    assert sorted(result.columns) == sorted(twin.columns)
    columns = sorted(result.columns)
    expected = Counter(twin.select(*[f'"{c}"' for c in columns]).fetchall())
    rows = Counter(tuple(r) for r in result.select(*columns).collect())
    assert rows == expected
