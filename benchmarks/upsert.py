"""Seconds per upsert against the size of the table and of the batch.

The table is ``lineitem`` several times over, one row per key. Prints one JSON line
per pair of sizes. Settings as in ``bench.py``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratafeed.operators import latest_version, upsert  # noqa: E402
from stratafeed.sources.storage import new_folder  # noqa: E402

KEYS = ["l_orderkey", "l_linenumber"]


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
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    unique = latest_version(lines, KEYS, "l_shipdate")
    for copies in (1, 4, 16):
        table = spread(spark, unique, copies)
        for year in (2001, 1998, 1995):
            batch_folder = new_folder(spark, "batch")
            table.where(F.year("l_shipdate") >= year).write.parquet(batch_folder)
            batch = spark.read.parquet(batch_folder)
            seconds = {}
            for name, version in (("plain", None), ("versioned", "l_shipdate")):
                times = []
                for _ in range(4):
                    start = time.perf_counter()
                    merged = upsert(table, batch, KEYS, version, null_safe=True)
                    merged.write.format("noop").mode("overwrite").save()
                    times.append(time.perf_counter() - start)
                seconds[name] = round(statistics.median(times[1:]), 2)
            sizes = {"table_rows": table.count(), "batch_rows": batch.count()}
            print(json.dumps(sizes | seconds), flush=True)
    spark.stop()


def spread(spark: SparkSession, rows, copies: int):
    folder = new_folder(spark, "table")
    numbered = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    rows.select("*", numbered).withColumn(
        "l_orderkey", F.col("l_orderkey") + F.col("copy") * 100_000_000
    ).drop("copy").repartition(8).write.parquet(folder)
    return spark.read.parquet(folder)


if __name__ == "__main__":
    main()
