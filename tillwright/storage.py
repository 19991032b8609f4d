"""Folders in whatever storage Spark reaches, through its own file system interface."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _at(spark, path)
    return fs.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones and markers left out; none if there is no such folder."""
    fs, folder = _at(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return [n for n in names if not n.startswith(("_", "."))]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern with ``*`` in it."""
    fs, folder = _at(spark, pattern)
    return [status.getPath().toString() for status in fs.globStatus(folder) or ()]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, folder = _at(spark, path)
    return fs.getContentSummary(folder).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    fs, folder = _at(spark, path)
    return fs.delete(folder, True)


def claim(spark: SparkSession, path: str) -> None:
    """Create an empty file; an error if it exists, also for the later of two that try at once."""
    fs, file = _at(spark, path)
    try:
        fs.create(file, False).close()
    except Py4JJavaError as error:
        raise FileExistsError(f"{path} is there already") from error


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a file or folder at once; an error if it is no longer there."""
    fs, folder = _at(spark, source)
    _, to = _at(spark, target)
    fs.mkdirs(to.getParent())
    try:
        done = fs.rename(folder, to)
    except Py4JJavaError as error:
        raise FileNotFoundError(f"{source} is gone") from error
    if not done:
        raise FileNotFoundError(f"{source} could not be moved to {target}")
