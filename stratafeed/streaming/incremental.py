"""Everything that is available, as micro-batches, into a keyed table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.quality import conform, has_required, split_valid
from ..functions.text import normalise_iso
from ..operators.dedup import latest_version
from ..schemas import TableSpec
from ..sources import files, keyed
from ..sources.storage import exists

_POOL = "spark.scheduler.pool"
_POLL_SECONDS = 0.05
_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Bytes of files in one task of a stream. Rows are sorted before they are shuffled, to
#: leave out all but one of a key, and take many times the bytes of their files.
_SPLIT_BYTES = 32 << 20


def clean_batch(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key: gate, required fields, latest version, typed timestamps.

    A version in text is parsed, with its fraction, before rows are ranked, and that
    value is stored: the guard of the table compares what the ranking compared, however
    rows are spread over batches. A version that does not parse is older than any other.
    """
    good, _ = split_valid(through_gate(df, spec), spec.required)
    other = [c for c in spec.iso_columns if c != spec.version]
    if spec.version in spec.iso_columns:
        good = normalise_iso(good, [spec.version], keep_fraction=True)
    latest = latest_version(good, spec.keys, spec.version, spec.tie_break)
    return conform(normalise_iso(latest, other, spec.keep_fraction), spec.schema)


def rejected_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that ``clean_batch`` leaves out for a missing required field."""
    return split_valid(through_gate(df, spec), spec.required)[1]


def through_gate(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df if spec.gate is None else df.where(F.col(spec.gate))


def run_incremental(
    spark: SparkSession,
    stream: DataFrame,
    path: str,
    spec: TableSpec,
    compact_share: float = 0.2,
    timeout: int | None = None,
) -> None:
    """Bring the table at ``path`` up to date with a file stream, then stop."""
    with bounded_splits(spark):
        finish([start_incremental(spark, stream, path, spec, compact_share)], timeout)


@contextmanager
def bounded_splits(spark: SparkSession) -> Iterator[None]:
    """Within it, tasks that read files get small splits, so that what they sort before a
    shuffle stays in memory. The session has its own setting again afterwards."""
    before = spark.conf.get(_SPLIT)
    allowed = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    spark.conf.set(_SPLIT, str(min(allowed, _SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


def start_incremental(
    spark: SparkSession,
    stream: DataFrame,
    path: str,
    spec: TableSpec,
    compact_share: float = 0.2,
    pool: str | None = None,
) -> StreamingQuery:
    """Begin to bring the table at ``path`` up to date with a file stream.

    The first run is the full load; a later one sees only new files. The
    checkpoint lies inside the table folder, because batch numbers name its
    increments. Rows without a required field are kept under ``rejected``. If the
    stream has the column ``files.CORRUPT``, rows with a text in it are kept, as file
    and text, under ``malformed``, whatever the gate says. The increments are folded
    into the base when they reach ``compact_share`` of it.
    """
    checkpoint = f"{path}/_checkpoint"
    if keyed.is_stored(spark, path) and not exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(
            f"{path} has data but no checkpoint: a new stream would reuse the "
            "numbers of its batches"
        )

    kept_apart = files.CORRUPT in stream.columns
    broken = F.col(files.CORRUPT).isNotNull() if kept_apart else F.lit(False)

    def whole(batch: DataFrame) -> DataFrame:
        return batch.where(~broken).select(*spec.schema.names) if kept_apart else batch

    def store(batch: DataFrame, number: int) -> None:
        # Rejects are counted while the increment is written; the batch is read a
        # second time only if there are any.
        seen = Observation()
        missing = F.count_if(~broken & ~has_required(spec.required)).alias("rejected")
        malformed = F.count_if(broken).alias("malformed")
        observed = batch.observe(seen, missing, malformed)
        keyed.write_increment(clean_batch(whole(observed), spec), path, number)
        if seen.get["rejected"]:
            rejected_rows(whole(batch), spec).write.mode("overwrite").parquet(
                f"{path}/rejected/batch={number}"
            )
        if seen.get["malformed"]:
            texts = batch.where(broken).select(
                F.col(files.FILE).alias("file"), F.col(files.CORRUPT).alias("text")
            )
            texts.write.mode("overwrite").parquet(f"{path}/malformed/batch={number}")
        keyed.compact_if_due(spark, path, spec, compact_share)

    # The batch that foreachBatch hands over is no longer part of the scan's plan,
    # so the gate and the projection are applied to the stream, where they reach it.
    if kept_apart:
        gate = F.lit(True) if spec.gate is None else F.col(spec.gate)
        narrowed = stream.where(broken | gate).select(
            *spec.schema.names, files.FILE, files.CORRUPT
        )
    else:
        narrowed = conform(through_gate(stream, spec), spec.schema)
    return start(narrowed, store, checkpoint, pool)


def drain(
    stream: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    timeout: int | None = None,
) -> None:
    """Give every available micro-batch to ``store``, then stop."""
    finish([start(stream, store, checkpoint)], timeout)


def start(
    stream: DataFrame,
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    pool: str | None = None,
) -> StreamingQuery:
    """Begin to give every available micro-batch to ``store``.

    ``pool`` names the scheduler pool of its jobs: with ``spark.scheduler.mode=FAIR``
    streams in pools of their own share the executors evenly. A batch may come twice after a failure, with the same number and rows, so
    ``store`` has to overwrite what it wrote for that number.
    """
    context = stream.sparkSession.sparkContext
    before = context.getLocalProperty(_POOL)
    # A stream's thread takes over the properties of the one that starts it.
    context.setLocalProperty(_POOL, before if pool is None else pool)
    try:
        return (
            stream.writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .outputMode("update")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        context.setLocalProperty(_POOL, before)


def finish(queries: Sequence[StreamingQuery], timeout: float | None = None) -> None:
    """Wait until all streams have drained.

    As soon as one fails, the others are stopped and its error is raised; what they have
    committed stays, and the rest is taken up by the next run. The same holds if
    ``timeout`` seconds are not enough.
    """
    ends = None if timeout is None else time.monotonic() + timeout
    try:
        while any([q.isActive for q in queries]):
            if any(q.exception() for q in queries if not q.isActive):
                break
            if ends is not None and time.monotonic() > ends:
                raise TimeoutError(f"the streams were not drained within {timeout} seconds")
            time.sleep(_POLL_SECONDS)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
