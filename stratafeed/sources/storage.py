"""Folders on the file system of the cluster, and settings of a session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Within it, the session has another setting; its own one again afterwards."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one for local sessions."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stratafeed-")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders; none if the path does not exist."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """True once a write job has committed the folder."""
    return exists(spark, f"{path}/_SUCCESS")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own and everything below it."""
    fs, p = _open(spark, path)
    fs.delete(p, True)


def replace_folder(spark: SparkSession, path: str, by: str) -> None:
    """Put the folder ``by`` in the place of ``path``; an empty one if there is no ``by``."""
    fs, p = _open(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(by)
    fs.delete(p, True)
    if not fs.exists(source):
        fs.mkdirs(p)
        return
    fs.mkdirs(p.getParent())
    if not fs.rename(source, p):
        raise OSError(f"{by} could not be moved to {path}")


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def files_in(spark: SparkSession, path: str) -> int:
    """Number of files directly in a folder; none if it does not exist."""
    fs, p = _open(spark, path)
    return sum(s.isFile() for s in fs.listStatus(p)) if fs.exists(p) else 0


def move_files(spark: SparkSession, path: str, into: str) -> None:
    """Put the files of a folder beside those of another one, which is made if need be."""
    fs, p = _open(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(into)
    fs.mkdirs(target)
    for status in fs.listStatus(p):
        if status.isFile() and not fs.rename(status.getPath(), target):
            raise OSError(f"{status.getPath()} could not be moved to {into}")


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p
