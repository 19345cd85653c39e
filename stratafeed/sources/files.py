"""File sources and append sinks, always with a declared schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.days import day_of
from ..operators.dedup import latest_version
from .storage import list_folders

# By default a file stream skips files more than a week older than the newest one it
# has seen, such as a late copy that kept its modification time.
ANY_AGE = "36500d"

# Fixed value: text form of zone-free timestamps in JSON, microseconds kept.
JSON_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

#: Column that keeps the text of a document that does not parse as declared.
CORRUPT = "_corrupt_record"
#: Column that keeps the file of a row whose text may have to be kept.
FILE = "__file"
#: Bytes of a row group of raw rows, which one task reads as a whole.
ROW_GROUP_BYTES = 32 << 20
#: Partition column of a feed that is kept by day.
DAY_FOLDER = "day_folder"
_COPIES, _DIGEST, _DONE, _PIECES = "__copies", "__digest", "__done", "__pieces"


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` and the column for the text of what does not parse as declared."""
    return T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("timestampNTZFormat", JSON_NTZ_FORMAT)
        .json(path)
    )


def read_parquet(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return spark.read.schema(schema).parquet(*paths)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet"
) -> DataFrame | None:
    """The files of ``path``, or None if there is no such path.

    Only a missing path is tolerated; any other error is raised.
    """
    reader = read_json if format == "json" else read_parquet
    try:
        return reader(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_payloads(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    one_per_file: bool = True,
) -> DataFrame:
    """Nested documents, all of them in one job.

    A document whose top level is an array gives one row per element, and an empty
    array none. With ``one_per_file=False`` each line is a document, which lets
    Spark split large files.
    """
    return (
        spark.read.schema(schema)
        .option("multiLine", one_per_file)
        .option("timestampNTZFormat", JSON_NTZ_FORMAT)
        .json(path)
    )


def stream_payloads(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    one_per_file: bool = True,
    intake: int | Intake | None = None,
) -> DataFrame:
    """``read_payloads`` over the files that are new.

    If ``schema`` has the column ``CORRUPT``, it holds the text of a document that does
    not parse as declared.
    """
    reader = _limited(spark.readStream.schema(schema), intake)
    return (
        reader.option("multiLine", one_per_file)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("timestampNTZFormat", JSON_NTZ_FORMAT)
        .json(path)
    )


def stream_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    intake: int | Intake | None = None,
) -> DataFrame:
    """Lines of JSON in new files.

    If ``schema`` has the column ``CORRUPT``, it holds the text of a line that does not
    parse as declared, and the column ``FILE`` the file of each row.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("timestampNTZFormat", JSON_NTZ_FORMAT)
    )
    # A folder of a day may be replaced after its files were listed; its rows come again
    # with the new files.
    reader = _limited(reader, intake).option("ignoreMissingFiles", True)
    rows = reader.option("recursiveFileLookup", True).json(path)
    if CORRUPT not in rows.columns:
        return rows
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def stream_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    intake: int | Intake | None = None,
    name_glob: str | None = None,
) -> DataFrame:
    """Parquet files below a folder, or below what ``name_glob`` names in it.

    The glob picks files or folders directly in ``path``, so a table may be one file or
    a folder of part files.
    """
    reader = _limited(spark.readStream.schema(schema), intake)
    if name_glob is not None:
        path = f"{path}/{name_glob}"
    return reader.option("recursiveFileLookup", True).parquet(path)


def append_json(df: DataFrame, path: str) -> None:
    """Append rows as JSON lines; one file per partition, written in parallel."""
    df.write.mode("append").option("timestampNTZFormat", JSON_NTZ_FORMAT).json(path)


def append_parquet(df: DataFrame, path: str) -> None:
    """Append rows in row groups of bounded size: a split of a file holds whole ones."""
    df.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def overwrite_partitions(
    df: DataFrame,
    path: str,
    by: str,
    format: str = "parquet",
    pieces: str | None = None,
    tasks: int = 1,
) -> None:
    """Write rows to one folder per value of ``by``; a folder that gets rows loses the ones
    it had, any other folder stays.

    Rows of a value come together before they are written, in as many tasks and files as
    the column ``pieces`` says, by default one; that column is not written. A repeated
    write replaces what it wrote. ``df`` may read from the same path. There are at least
    ``tasks`` tasks, and as many as the session's shuffles have.
    """
    spread = [F.col(by)]
    if pieces is not None:
        spread.append(F.pmod(F.xxhash64(*df.columns), F.col(pieces)))
    # A given number of tasks, as a folder costs time even where its rows are few.
    tasks = max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.repartition(tasks, *spread)
    (
        (rows if pieces is None else rows.drop(pieces))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampNTZFormat", JSON_NTZ_FORMAT)
        .partitionBy(by)
        .format(format)
        .save(path)
    )


def overwrite_days(
    df: DataFrame, path: str, day: str, format: str = "json", rows_per_file: int = 1_000_000
) -> None:
    """``overwrite_partitions`` by the day of each row; rows without a day are left out.

    Rows per day are counted first, so that a day with very many is written by many
    tasks, in files of about ``rows_per_file``, and any other day is one file.
    """
    own = df.withColumn(DAY_FOLDER, day_of(df, day)).where(F.col(DAY_FOLDER).isNotNull())
    large = (
        own.groupBy(DAY_FOLDER)
        .agg(F.ceil(F.count("*") / rows_per_file).alias(_PIECES))
        .where(F.col(_PIECES) > 1)
    )
    # Days with that many rows are few, so the others are not shuffled to find them.
    counted = own.join(F.broadcast(large), DAY_FOLDER, "left").withColumn(
        _PIECES, F.coalesce(F.col(_PIECES), F.lit(1))
    )
    overwrite_partitions(counted, path, DAY_FOLDER, format, _PIECES)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "json"
) -> DataFrame:
    """A feed kept by day; a condition on ``DAY_FOLDER`` leaves other folders unread."""
    whole = T.StructType([*schema, T.StructField(DAY_FOLDER, T.DateType())])
    return (
        spark.read.schema(whole)
        .option("timestampNTZFormat", JSON_NTZ_FORMAT)
        .format(format)
        .load(path)
    )


def stored_days(spark: SparkSession, path: str, day: str) -> DataFrame | None:
    """The days a feed kept by day holds, by the names of its folders; None without any.

    Nothing is read. The names come to the driver, one per day.
    """
    names = (name.partition("=") for name in list_folders(spark, path))
    days = [(dt.date.fromisoformat(d),) for column, _, d in names if column == DAY_FOLDER]
    return spark.createDataFrame(days, T.StructType([T.StructField(day, T.DateType())])) if days else None


def day_bounds(
    spark: SparkSession, path: str, day: str
) -> tuple[dt.date | None, dt.date | None]:
    """Oldest and newest day of parquet files with a date column, from their footers.

    The statistics that each file keeps of its columns are read, not the rows; a session
    of its own has the reader that can do so, the settings of ``spark`` stay.
    """
    bounds = footer_bounds(spark, path, day).first()
    return bounds.min_day, bounds.max_day


def footer_bounds(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The row behind ``day_bounds``: its plan has the aggregate pushed into the scan."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    days = own.read.parquet(path)
    if not isinstance(days.schema[day].dataType, T.DateType):
        raise ValueError(f"{day} is no date: footers order its values in another way")
    return days.agg(F.min(day).alias("min_day"), F.max(day).alias("max_day"))


def write_documents(df: DataFrame, path: str, per_file: int = 200_000) -> None:
    """Append each row as one line holding a JSON array of one document.

    Field names make up most of the text, so files are compressed, for which the fastest
    level does; ``per_file`` documents at most keep one, which a reader cannot split, to the
    work of a short task.
    """
    document = F.to_json(
        F.array(F.struct(*df.columns)), {"timestampNTZFormat": JSON_NTZ_FORMAT}
    )
    (
        df.select(document.alias("value"))
        .write.mode("append")
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


def each_once(
    payloads: DataFrame, path: str, key: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Non-empty payloads, one per id, with the id of ``path`` as column ``key``.

    A document without an id is empty; one with an id and no children is not. Among
    copies of an id the highest by ``order`` is taken. By default a digest of the whole
    document decides, so that documents themselves are never compared or sorted.
    """
    return _one_per_id(by_id(payloads, path, key), key, order)


def by_id(payloads: DataFrame, path: str, key: str) -> DataFrame:
    """Non-empty payloads with the id of ``path`` as column ``key``, brought together by it.

    Payloads that have this column are taken as they lie. The number of partitions is
    that of the session's shuffles, and stays: rows take many times the memory of their
    shuffled bytes, by which partitions would be merged again.
    """
    if key in payloads.columns:
        return payloads
    present = payloads.withColumn(key, F.col(path)).where(F.col(key).isNotNull())
    tasks = int(payloads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return present.repartition(tasks, key)


def select_landable(
    payloads: DataFrame,
    landed: DataFrame | None,
    path: str,
    key: str,
    order: Sequence[str] | None = None,
    waits: str | None = None,
) -> DataFrame:
    """Payloads to land: not empty, each id once, not among the ids of ``landed``.

    Those with the flag ``waits``, the same for all copies of an id, are given whether
    landed or not; rows come in its order, so that a write by it sorts nothing.

    What has landed is left out first, by ids; only the others are compared. Ids are
    shuffled to the documents (``by_id``), not broadcast, and documents are sorted there,
    not in splits of files, however large these are.
    """
    fresh = by_id(payloads, path, key)
    if landed is not None:
        # An anti-join would be moved below the shuffle, and shuffle by itself.
        done = landed.select(key).distinct().withColumn(_DONE, F.lit(True))
        fresh = fresh.join(done.hint("shuffle_hash"), key, "left")
        is_open = F.col(_DONE).isNull()
        fresh = fresh.where(is_open if waits is None else is_open | F.col(waits)).drop(_DONE)
    apart = [] if waits is None else [waits]
    return _one_per_id(fresh, key, order, apart).select(*payloads.columns)


def _one_per_id(
    present: DataFrame, key: str, order: Sequence[str] | None, apart: Sequence[str] = ()
) -> DataFrame:
    """``apart`` names columns that are the same for all copies of an id, to sort by first."""
    groups = [*apart, key]
    if order is not None:
        return latest_version(present, groups, None, order)
    # Only copies are compared, so that a document that has none is not made text again.
    copies = F.count("*").over(Window.partitionBy(*groups))
    whole = F.struct(*[c for c in present.columns if c not in apart])
    digest = F.when(F.col(_COPIES) > 1, F.sha2(F.to_json(whole), 256))
    marked = present.withColumn(_COPIES, copies).withColumn(_DIGEST, digest)
    return latest_version(marked, groups, None, [_DIGEST]).drop(_COPIES, _DIGEST)


def ids_of(payloads: DataFrame, path: str, key: str) -> DataFrame:
    """The ids documents hold; over parquet only that one leaf is read."""
    return payloads.select(F.col(path).alias(key))


@dataclass(frozen=True)
class Intake:
    """How a file stream takes up its files, and what becomes of them.

    ``max_files`` or ``max_bytes`` bounds a micro-batch (a file that is larger alone is a
    batch of its own); without either a run is a single batch. ``archive`` is a folder on
    the file system of the input that files are moved to once their batch is done, so
    that listing the input stays cheap; the path of a file is kept below it. The files of
    a run's last batch are moved in the next run. Moving takes place in the background
    and may miss a file if the run is killed; the checkpoint, not the folder, tells what
    was read.
    """

    max_files: int | None = None
    max_bytes: int | None = None
    archive: str | None = None

    def __post_init__(self) -> None:
        if self.max_files is not None and self.max_bytes is not None:
            raise ValueError("bound a micro-batch by files or by bytes, not by both")


def _limited(reader, intake: int | Intake | None):
    """Apply an intake; a number bounds the files of a micro-batch."""
    if not isinstance(intake, Intake):
        intake = Intake(intake)
    reader = reader.option("maxFileAge", ANY_AGE)
    if intake.max_files is not None:
        reader = reader.option("maxFilesPerTrigger", intake.max_files)
    if intake.max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", intake.max_bytes)
    if intake.archive is not None:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", intake.archive
        )
    return reader
