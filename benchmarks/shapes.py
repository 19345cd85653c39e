"""Times each operator against the plain shape of the same query.

The plain shapes are the ones one would write first: a left join with a null test
for pending work, UNION ALL for counts from both sides, one aggregate for all
statistics, one output file per write, a full outer join for an upsert. Prints one
JSON line per pair. Settings as in ``bench.py``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratafeed.operators import entity_stats, pending, side_counts, upsert  # noqa: E402
from stratafeed.sources import files  # noqa: E402
from stratafeed.sources.storage import new_folder  # noqa: E402

COPIES = int(os.environ.get("BENCH_COPIES", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = enlarged(spark, f"{sf_dir}/lineitem.parquet", "l_orderkey")
    orders = enlarged(spark, f"{sf_dir}/orders.parquet", "o_orderkey")
    late = orders.where("o_orderdate >= TIMESTAMP '2001-07-01'").withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    batch_folder = new_folder(spark, "batch")
    late.write.parquet(batch_folder)
    batch = spark.read.parquet(batch_folder)
    done = lines.withColumnRenamed("l_orderkey", "o_orderkey")
    means = {f"avg_{c}": c for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    keys = ["l_suppkey", "l_returnflag"]

    def one_aggregate() -> DataFrame:
        return lines.groupBy(*keys).agg(
            F.count_distinct("l_orderkey").alias("n"),
            F.min("l_shipdate").alias("first"),
            F.max("l_shipdate").alias("last"),
            *[F.avg(c).alias(n) for n, c in means.items()],
        )

    def branches() -> DataFrame:
        shipped = "l_shipdate"
        return entity_stats(
            lines, keys, {"n": "l_orderkey"}, {"first": shipped}, {"last": shipped}, means
        )

    def union_all() -> DataFrame:
        sides = [
            lines.select(F.col(c).alias("flag"), "l_linenumber")
            for c in ("l_returnflag", "l_linestatus")
        ]
        return sides[0].unionAll(sides[1]).groupBy("flag", "l_linenumber").count()

    def full_outer() -> DataFrame:
        b = batch.select(*[F.col(c).alias(f"b_{c}") for c in batch.columns])
        joined = orders.join(b, orders["o_orderkey"] == b["b_o_orderkey"], "full")
        return joined.select(
            *[
                F.when(F.col("b_o_orderkey").isNotNull(), F.col(f"b_{c}"))
                .otherwise(F.col(c))
                .alias(c)
                for c in orders.columns
            ]
        )

    compare("statistics", cpus, one_aggregate, branches)
    compare(
        "both-sides counts",
        cpus,
        union_all,
        lambda: side_counts(
            lines,
            ["l_returnflag", "l_linestatus"],
            {"l_linenumber": "l_linenumber"},
            "flag",
            "count",
        ),
    )
    compare(
        "pending ids",
        cpus,
        lambda: orders.join(done, "o_orderkey", "left")
        .where("l_linenumber is null")
        .select("o_orderkey"),
        lambda: pending(orders, done, ["o_orderkey"]),
    )
    compare(
        "upsert of a small batch",
        cpus,
        full_outer,
        lambda: upsert(orders, batch, ["o_orderkey"], null_safe=True),
    )
    compare(
        "versioned upsert of a small batch",
        cpus,
        full_outer,
        lambda: upsert(orders, batch, ["o_orderkey"], "o_orderdate", null_safe=True),
    )
    compare_writes(spark, cpus, lines)
    spark.stop()


def enlarged(spark: SparkSession, file: str, key: str) -> DataFrame:
    """The table several times over, with keys of their own, in a scratch folder."""
    folder = new_folder(spark, "enlarged")
    table = spark.read.parquet(file)
    copies = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    table.select("*", copies).withColumn(
        key, F.col(key) + F.col("copy") * 100_000_000
    ).drop("copy").repartition(COPIES).write.parquet(folder)
    return spark.read.parquet(folder)


def compare(name: str, cpus: str, plain, ours) -> None:
    def run(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = [[run(shape) for _ in range(RUNS + 1)] for shape in (plain, ours)]
    report(name, cpus, *times)


def compare_writes(spark: SparkSession, cpus: str, lines: DataFrame) -> None:
    def run(df: DataFrame) -> float:
        start = time.perf_counter()
        files.append_json(df, new_folder(spark, "written"))
        return time.perf_counter() - start

    report(
        "append as JSON",
        cpus,
        [run(lines.coalesce(1)) for _ in range(2)],
        [run(lines) for _ in range(2)],
    )


def report(name: str, cpus: str, plain: list[float], ours: list[float]) -> None:
    a, b = (round(statistics.median(times[1:]), 2) for times in (plain, ours))
    print(json.dumps({"query": name, "cpus": cpus, "plain": a, "ours": b}), flush=True)


if __name__ == "__main__":
    main()
