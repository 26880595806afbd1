"""Text, JSON and collection inputs.

A queue of message batches is a directory of files here: each file is a batch, the
file stream takes them in order of arrival and the checkpoint remembers the
position, so a restart neither loses nor repeats one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

POLL_SECONDS = 5


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: ``value``, one row per line."""
    return spark.read.text(path)


def collection(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """SRC-2: a small in-memory collection."""
    return spark.createDataFrame(list(rows), schema)


def _stream(spark: SparkSession, files_per_trigger: int | None) -> DataStreamReader:
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader


def message_batches(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """SRC-4 and SRC-5: a stream of raw messages, one per line in ``value``.

    All files that are there make one micro-batch; with ``files_per_trigger`` 1 each
    file is one, and the next starts as soon as it is done.
    """
    return _stream(spark, files_per_trigger).text(path)


def json_batches(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    """SRC-4: a stream of JSON rows with a declared schema."""
    return _stream(spark, files_per_trigger).schema(schema).json(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """SRC-5: a broker topic as ``value``; needs the Kafka package on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .selectExpr("cast(value as string) as value")
    )
