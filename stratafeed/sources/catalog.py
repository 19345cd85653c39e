"""Databases, tables, schemas and query texts by name."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", {"name": name})


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def save_table(df: DataFrame, name: str) -> None:
    """Write or replace a managed table."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def publish_folder(spark: SparkSession, name: str, folder: str) -> None:
    """Make ``name`` a view of the parquet files in one folder.

    Replacing the view moves readers from one folder to the next in one step.
    """
    view = ".".join(map(_quoted, name.split(".")))
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.{_quoted(folder)}")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def load_schema(path: str) -> T.StructType:
    """A schema from the JSON form Spark writes (``StructType.json()``)."""
    return T.StructType.fromJson(json.loads(_text_of(path)))


def load_query(path: str) -> str:
    """The text of a SQL file, without a closing semicolon."""
    return _text_of(path).strip().removesuffix(";")


def _text_of(path: str) -> str:
    """A small text file, on any file system that Spark reads."""
    spark = SparkSession.active()
    return spark.read.text(path, wholetext=True).first().value
