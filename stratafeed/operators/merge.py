"""Upsert of a source into a keyed target."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import latest_version


class AmbiguousMergeError(ValueError):
    """Several source rows match one target row."""


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    version: str | None = None,
    null_safe: bool = False,
    unique: bool = False,
    large: bool = False,
) -> DataFrame:
    """``target`` after updating matched rows and inserting unmatched ones.

    Columns are those of ``target``; extra source columns are ignored. Of source rows
    with one key, the one with the highest version counts, ties (and all, without a
    version) decided by the remaining columns; rows that match nothing for a null key
    are all kept. ``unique`` says that the source holds each key once, which spares
    that step. A target that holds a key several times loses all of its rows to a
    source row, unless one of them is newer.

    * ``version=None``: a source row always replaces the row it matches.
    * ``version=col``: a source row older than the stored one is ignored; on equal
      versions the source row wins, and a null version is older than any other.
    * ``null_safe``: null keys match each other; otherwise they never match.

    Only keys (and versions) of ``source`` are joined to ``target``. While they fit
    under the broadcast threshold of the session, ``target`` is not shuffled at all.
    That is judged by bytes of files, which may be far fewer than those of the rows:
    with ``large`` no side is broadcast, so that no keys come to the driver.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    if not unique:
        source = _one_per_key(source, keys, version, null_safe)
    if version is not None:
        source = _not_stale(target, source, keys, version, null_safe, large)
    kept = _without_keys(target, not_broadcast(source.select(*keys), large), keys, null_safe)
    return kept.unionByName(source)


def _one_per_key(
    source: DataFrame, keys: list[str], version: str | None, null_safe: bool
) -> DataFrame:
    if null_safe:
        return latest_version(source, keys, version)
    complete = latest_version(source.where(_all_present(keys)), keys, version)
    return complete.unionByName(source.where(~_all_present(keys)))


def not_broadcast(df: DataFrame, large: bool = True) -> DataFrame:
    """``df``, which is shuffled and sorted for a join if it is ``large``."""
    return df.hint("merge") if large else df


def ambiguous_matches(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    large: bool = False,
) -> DataFrame:
    """Keys that several source rows share and the target holds, with the count."""
    keys = list(keys)
    repeated = (
        source.groupBy(*keys)
        .agg(F.count("*").alias("source_rows"))
        .where("source_rows > 1")
    )
    return repeated.alias("incoming").join(
        not_broadcast(target.select(*keys), large).alias("stored"),
        _same_key(keys, null_safe),
        "left_semi",
    )


def require_unambiguous(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    large: bool = False,
) -> None:
    """Raise if a merge of ``source`` could update one target row twice."""
    clashes = ambiguous_matches(target, source, keys, null_safe, large).take(3)
    if clashes:
        raise AmbiguousMergeError(
            f"several source rows match one target row, for example {clashes}"
        )


def merge_into_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    version: str | None = None,
    null_safe: bool = False,
) -> None:
    """The same upsert as one MERGE, for catalog tables whose format supports it."""
    keys = list(keys)
    stored, incoming = table, "incoming"
    same = _same_key(keys, null_safe, stored, incoming)
    merge = source.alias(incoming).mergeInto(table, same)
    if version is None:
        merge = merge.whenMatched().updateAll()
    else:
        older = _is_newer(_ref(stored, version), _ref(incoming, version))
        merge = merge.whenMatched(~older).updateAll()
    merge.whenNotMatched().insertAll().merge()


def _not_stale(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    version: str,
    null_safe: bool,
    large: bool,
) -> DataFrame:
    # The stored rows that the source touches at all: at most one per source key,
    # and only keys and version are read for them.
    touched = (
        target.select(*keys, version)
        .alias("stored")
        .join(
            not_broadcast(source.select(*keys), large).alias("incoming"),
            _same_key(keys, null_safe),
            "left_semi",
        )
    )
    beaten = _same_key(keys, null_safe) & _is_newer(
        _ref("stored", version), _ref("incoming", version)
    )
    stored = not_broadcast(touched, large).alias("stored")
    return source.alias("incoming").join(stored, beaten, "left_anti")


def _without_keys(
    target: DataFrame, drop: DataFrame, keys: list[str], null_safe: bool
) -> DataFrame:
    joined = target
    if not null_safe:
        joined = target.where(_all_present(keys))
    kept = joined.alias("stored").join(
        drop.alias("incoming"), _same_key(keys, null_safe), "left_anti"
    )
    if null_safe:
        return kept
    # Null keys match nothing; going round the join keeps them from meeting in one
    # shuffle partition.
    return kept.unionByName(target.where(~_all_present(keys)))


def _same_key(
    keys: list[str],
    null_safe: bool,
    left: str = "stored",
    right: str = "incoming",
) -> Column:
    pairs = ((_ref(left, k), _ref(right, k)) for k in keys)
    return reduce(
        and_, (a.eqNullSafe(b) if null_safe else a == b for a, b in pairs)
    )


def _is_newer(a: Column, b: Column) -> Column:
    """``a > b`` with null below every value; never null itself."""
    return F.coalesce(a > b, a.isNotNull() & b.isNull())


def _all_present(keys: list[str]) -> Column:
    return reduce(and_, (F.col(k).isNotNull() for k in keys))


def _ref(relation: str, column: str) -> Column:
    return F.col(f"{relation}.`{column}`")
