"""Keyed tables as parquet folders: a base and the increments since.

A table folder holds ``base=<n>`` (every key once, all increments up to ``n``
folded in) and ``increment=<n>`` (one deduplicated batch each). Folders are
written once by an ordinary write job and count only when that job committed.

* A batch costs a write of its own size; the base is not rewritten for it.
* A repeated batch overwrites its own folder, so a retry changes nothing.
* The current state is an upsert of the increments into the base. Only keys of the
  increments are joined, so a base is read without a shuffle while the increments
  are small; ``compact_if_due`` folds them in once they reach a share of its size,
  so the bytes rewritten stay in proportion to the bytes that arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import latest_version
from ..operators.merge import require_unambiguous, upsert
from ..schemas import TableSpec
from .storage import exists, is_complete, list_folders, remove_folder, size_of

_BASE = "base"
_INCREMENT = "increment"
#: Rows of changes whose keys may be broadcast; rows are counted by the footers of files.
_MOST_BROADCAST = 100_000


def write_increment(df: DataFrame, path: str, number: int) -> None:
    """Store one deduplicated batch under its number.

    A number up to that of the base is only good for repeating a batch that the
    base already holds.
    """
    folder = _folder(path, _INCREMENT, number)
    folded, _ = _state(df.sparkSession, path)
    if number <= folded and not exists(df.sparkSession, folder):
        raise ValueError(f"batch {number} is new, but the base is at {folded}")
    df.write.mode("overwrite").parquet(folder)


def read_current(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Current rows: every key once; an absent table is an empty one."""
    schema = spec.stored_schema
    folded, increments = _state(spark, path)
    stored = changes = None
    if folded >= 0:
        stored = spark.read.schema(schema).parquet(_folder(path, _BASE, folded))
    if increments:
        changes = _winners(spark, path, spec, increments)
    if stored is None and changes is None:
        # The condition tells the planner that it is empty.
        return spark.createDataFrame([], schema).where(F.lit(False))
    if stored is None or changes is None:
        return changes if stored is None else stored
    return upsert(
        stored, changes, spec.keys, spec.version, null_safe=True, unique=True,
        large=_is_large(_rows_of(spark, path, spec, increments)),
    )


def compact(spark: SparkSession, path: str, spec: TableSpec) -> str | None:
    """Fold open increments into a new base; the folder of the newest base."""
    folded, increments = _state(spark, path)
    if increments:
        folded = increments[-1]
        _write_base(read_current(spark, path, spec), path, folded)
    return _folder(path, _BASE, folded) if folded >= 0 else None


def compact_if_due(
    spark: SparkSession, path: str, spec: TableSpec, share: float
) -> None:
    """Compact once the open increments hold ``share`` of the bytes of the base.

    A single increment without a base is left alone: its keys are unique already.
    """
    folded, increments = _state(spark, path)
    if not increments or (folded < 0 and len(increments) == 1):
        return
    stored = size_of(spark, _folder(path, _BASE, folded)) if folded >= 0 else 0
    arrived = sum(size_of(spark, _folder(path, _INCREMENT, n)) for n in increments)
    if arrived >= share * stored:
        compact(spark, path, spec)


def upsert_table(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    source: DataFrame,
    check: bool = True,
) -> str:
    """Merge a whole recomputed source into the table; the folder of the new base.

    For sources about as large as the table, such as its own recomputation: the
    merged rows become the next base at once. The source is computed once, into a
    folder of its own, and checked and merged from there. ``check`` refuses a
    source that would update one row twice.
    """
    folded, increments = _state(spark, path)
    number = max(folded, *increments) + 1 if increments else folded + 1
    staged = _folder(path, "staged", number)
    source.select(*spec.schema.names).write.mode("overwrite").parquet(staged)
    source = spark.read.schema(spec.stored_schema).parquet(staged)
    target, large = read_current(spark, path, spec), _is_large(source)
    if check:
        require_unambiguous(target, source, spec.keys, null_safe=True, large=large)
    merged = upsert(target, source, spec.keys, spec.version, null_safe=True, large=large)
    _write_base(merged, path, number)
    remove_folder(spark, staged)
    return _folder(path, _BASE, number)


def open_increments(spark: SparkSession, path: str) -> int:
    """How many increments have not been folded into a base."""
    return len(_state(spark, path)[1])


def is_stored(spark: SparkSession, path: str) -> bool:
    folded, increments = _state(spark, path)
    return folded >= 0 or bool(increments)


def remove_superseded(spark: SparkSession, path: str) -> None:
    """Delete the bases before the newest one, and the increments it holds.

    For when no reader uses them any more. The last increment it holds stays, because
    a stream may repeat that batch.
    """
    folded, _ = _state(spark, path)
    for kind, numbers in _folders(spark, path).items():
        for number in numbers:
            if number < folded:
                remove_folder(spark, _folder(path, kind, number))


def _winners(
    spark: SparkSession, path: str, spec: TableSpec, increments: list[int]
) -> DataFrame:
    """The row of each key that the increments leave; the later one on a tie."""
    rows = _rows_of(spark, path, spec, increments)
    if len(increments) == 1:
        return rows.drop(_INCREMENT)
    # An increment holds a key once, so ranking before the shuffle would leave out next to
    # nothing; rows are sorted after it only.
    together = rows.repartition(*spec.keys)
    return latest_version(together, spec.keys, spec.version, [_INCREMENT]).drop(_INCREMENT)


def _rows_of(
    spark: SparkSession, path: str, spec: TableSpec, increments: list[int]
) -> DataFrame:
    """All rows of some increments, with the number of theirs."""
    folders = [_folder(path, _INCREMENT, n) for n in increments]
    numbered = T.StructType([*spec.stored_schema, T.StructField(_INCREMENT, T.LongType())])
    return spark.read.schema(numbered).option("basePath", path).parquet(*folders)


def _is_large(rows: DataFrame) -> bool:
    return rows.count() > _MOST_BROADCAST


def _write_base(df: DataFrame, path: str, number: int) -> None:
    df.write.mode("overwrite").parquet(_folder(path, _BASE, number))


def _state(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The number of the newest base, -1 without one, and those of open increments.

    Only committed folders count. That is looked up for the newest base and for the
    increments after it, so the work does not grow with what was folded before.
    """
    found = _folders(spark, path)
    bases = sorted(found[_BASE], reverse=True)
    folded = next((n for n in bases if is_complete(spark, _folder(path, _BASE, n))), -1)
    later = sorted(n for n in found[_INCREMENT] if n > folded)
    return folded, [n for n in later if is_complete(spark, _folder(path, _INCREMENT, n))]


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Numbers of the folders of each kind, by one listing."""
    found: dict[str, list[int]] = {_BASE: [], _INCREMENT: []}
    for name in list_folders(spark, path):
        kind, _, number = name.partition("=")
        if kind in found:
            found[kind].append(int(number))
    return found


def _folder(path: str, kind: str, number: int) -> str:
    return f"{path}/{kind}={number}"
