"""Small files in shared storage: listing them, and letting one appear whole or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    """Spark's file system of a path, and the path in its terms."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, so that it means the same to every process."""
    fs, target = filesystem(spark, path)
    return fs.makeQualified(target).toString()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, folder = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Let a small file appear by one rename; false, and no change, if the name is taken.

    Needs storage that renames without overwriting, as HDFS does.
    """
    fs, staged = filesystem(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    _, final = filesystem(spark, f"{folder}/{name}")
    out = fs.create(staged, False)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final) or not fs.rename(staged, final):
        fs.delete(staged, False)
        return False
    return True
