"""Tables defined by SQL text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..schemas import TableSpec
from ..sources import catalog, keyed


def run_sql_table(
    spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The result of a query over catalog tables and the given named frames.

    The names hold for this query only: temporary views of the session with the same
    names are as before when it returns.
    """
    with _named(spark, views or {}):
        return spark.sql(sql)


def run_sql_tables(
    spark: SparkSession,
    queries: Mapping[str, str],
    views: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Results of queries that may read each other by name, in order of dependence.

    A query is taken up once all names in it are known; Spark's analysis tells, so names
    in subqueries count, and names that a query defines for itself do not. If the queries
    that remain only wait for each other, or for what nothing has, ``LookupError`` names
    them and nothing is computed. Temporary views with the name of a query are set aside
    meanwhile, and a table with such a name is refused: it is not to be told whether the
    table or the query is meant. Results are lazy and in order, each after all it reads.
    """
    known, results, waiting = dict(views or {}), {}, dict(queries)
    clash = sorted(set(queries) & set(known))
    if clash:
        raise ValueError(f"given as frames and as queries: {clash}")
    while waiting:
        found: dict[str, DataFrame] = {}
        missing: dict[str, str] = {}
        with _named(spark, known, absent=waiting):
            for name, sql in waiting.items():
                try:
                    found[name] = spark.sql(sql)
                except AnalysisException as error:
                    if error.getCondition() != "TABLE_OR_VIEW_NOT_FOUND":
                        raise
                    missing[name] = error.getMessageParameters()["relationName"]
        if not found:
            raise LookupError(f"queries that wait for what is not there: {missing}")
        results |= found
        known |= found
        waiting = {name: queries[name] for name in missing}
    return results


@contextmanager
def _named(
    spark: SparkSession, views: Mapping[str, DataFrame], absent: Iterable[str] = ()
) -> Iterator[None]:
    """Names for some frames, and none for ``absent``; as before when it ends."""
    names = [*views, *absent]
    present = {n: spark.table(n) for n in names if spark.catalog.tableExists(n)}
    # Only what can be dropped was a temporary view; a table of that name stays.
    hidden = {n: df for n, df in present.items() if spark.catalog.dropTempView(n)}
    try:
        taken = sorted(n for n in absent if n in present and n not in hidden)
        if taken:
            raise ValueError(f"there are tables with the names of queries: {taken}")
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        yield
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)


def refresh_sql_table(
    spark: SparkSession,
    database: str,
    path: str,
    spec: TableSpec,
    result: DataFrame,
) -> None:
    """Merge a query result into a keyed table and publish it by name.

    Groups that the result no longer holds stay in the table.
    """
    catalog.ensure_database(spark, database)
    folder = keyed.upsert_table(spark, path, spec, result)
    catalog.publish_folder(spark, f"{database}.{spec.name}", folder)
