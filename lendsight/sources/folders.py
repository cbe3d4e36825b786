"""Folders of partitioned tables, through the file system that Spark writes them to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the folders ``column=value`` right below ``path``, in order; none if ``path`` is not there."""
    root, files = _path(spark, path)
    if not files.exists(root):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(root) if entry.isDirectory()]
    return sorted(name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}="))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it is not there."""
    folder, files = _path(spark, path)
    files.delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _path(spark, path)
    return files.exists(found)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of what lies right below ``path``."""
    root, files = _path(spark, path)
    return " ".join(sorted(f"{e.getPath().getName()}:{e.getLen()}:{e.getModificationTime()}" for e in files.listStatus(root)))
