"""Listing and deleting table folders through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``, sorted; none where it does not exist. One listing."""
    folder, fs = _opened(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())


def values(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the ``key=value`` folders in ``path``, sorted as text."""
    return [n.split("=", 1)[1] for n in subfolders(spark, path) if n.startswith(f"{key}=")]


def finished(spark: SparkSession, path: str, key: str) -> list[str]:
    """Those of :func:`values` whose write ended: Spark puts ``_SUCCESS`` there last of all."""
    done = []
    for value in values(spark, path, key):
        marker, fs = _opened(spark, f"{path}/{key}={value}/_SUCCESS")
        if fs.exists(marker):
            done.append(value)
    return done


def delete(spark: SparkSession, path: str) -> None:
    folder, fs = _opened(spark, path)
    fs.delete(folder, True)
