"""File sources and append sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratafeed.sources import files
from stratafeed.sources.storage import new_folder

from .registry import check, table


@check("SELECT * FROM events")
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = new_folder(spark, "json_roundtrip")
    files.append_json(events, path)
    return files.read_json(spark, path, events.schema)


@check("""
    SELECT * FROM conversations
    UNION ALL SELECT * FROM conversations WHERE role = 'user'
""")
def json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending keeps copies."""
    turns = table(spark, sf_dir, "conversations")
    path = new_folder(spark, "json_append")
    files.append_json(turns, path)
    files.append_json(turns.where("role = 'user'"), path)
    return files.read_json(spark, path, turns.schema)


@check("""
    SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_returnflag = 'R'
""")
def parquet_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    path = new_folder(spark, "parquet_append")
    files.append_parquet(lines, path)
    files.append_parquet(lines.where("l_returnflag = 'R'"), path)
    return files.read_parquet(spark, path, lines.schema)


@check("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 100000")
def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared schema of fewer columns: only those are read."""
    declared = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    return (
        files.read_parquet(spark, f"{sf_dir}/orders.parquet", declared.schema)
        .where("o_totalprice > 100000")
        .drop("o_totalprice")
    )
