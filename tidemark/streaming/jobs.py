"""Declared jobs: source, operator and sink."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.session import ROCKSDB_PROVIDER, new_path
from tidemark.functions.text import strict_from_json
from tidemark.operators.routing import tag_branches
from tidemark.sinks.changelog import settled
from tidemark.sinks.delivery import GATEWAY_FIELD, deliver
from tidemark.sinks.files import STORAGE_ORDER, print_rows, write_jdbc, write_stamped, write_text
from tidemark.sinks.keyed import upsert
from tidemark.sinks.partials import write_partials
from tidemark.sources.batch_queue import pending, queue_batches
from tidemark.sources.files import POLL_SECONDS, json_batches, kafka_messages, message_batches
from tidemark.storage import filesystem, names, publish
from tidemark.streaming.loops import iterate_batch

Operator = Callable[[DataFrame], DataFrame]
Source = Callable[..., DataFrame]
Sink = Callable[..., None]


@dataclass(frozen=True)
class Branch:
    """A sink for the rows where ``where`` holds; a row may be in several branches."""

    where: Column | str
    sink: str
    sink_options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class JobSpec:
    """One job. ``topic`` is the path or broker topic that the source reads.

    Rows go to one sink, or to several ``branches`` by name.
    """

    name: str
    topic: str
    operator: Operator
    source: str = "messages"
    source_options: Mapping[str, Any] = field(default_factory=dict)
    sink: str | None = None
    sink_options: Mapping[str, Any] = field(default_factory=dict)
    branches: Mapping[str, Branch] = field(default_factory=dict)
    parallelism: int | None = None
    output_mode: str = "append"
    poll_seconds: int = POLL_SECONDS
    until_drained: bool = False
    checkpoint: str | None = None


def each_batch(df: DataFrame, write: Callable[[DataFrame, int], Any]) -> DataStreamWriter:
    """ST-1: hand every micro-batch to ``write(rows, batch_id)`` as one window of values."""

    def run(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)

    return df.writeStream.foreachBatch(run)


def _console(rows: DataFrame, batch_id: int) -> None:
    print_rows(rows)


def _parquet(rows: DataFrame, batch_id: int, path: str) -> None:
    """Batches in their own directories, so a retried batch is stored once, and not again when a change has rewritten it."""
    if not settled(rows.sparkSession, path, batch_id):
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _text(rows: DataFrame, batch_id: int, path: str, column: str = "value") -> None:
    write_text(rows, f"{path}/batch_id={batch_id}", column, "overwrite")


def _stamped(rows: DataFrame, batch_id: int, path: str, schema: str | None = None, order: Sequence[str] = STORAGE_ORDER) -> None:
    """With ``schema`` the rows are JSON objects in ``value``; those that are not whole are left out."""
    if schema is not None:
        parsed = rows.select(strict_from_json("value", f"STRUCT<{schema}>").alias("row"))
        rows = parsed.filter("row IS NOT NULL").select("row.*")
    write_stamped(rows, path, batch_id, order)


def _deliver(
    rows: DataFrame, batch_id: int, path: str, send: Callable[[str], str], payload: str = "payload", field: str = GATEWAY_FIELD
) -> None:
    """Send each payload; results, dead letters among them, are stored under the batch's number."""
    _parquet(deliver(rows, send, payload, field), batch_id, path)


def _jdbc(rows: DataFrame, batch_id: int, url: str, table: str, **options: str) -> None:
    write_jdbc(rows, url, table, **options)


def _partials(rows: DataFrame, batch_id: int, path: str, **options: Any) -> None:
    write_partials(rows, path, batch_id, **options)


def _iterate(rows: DataFrame, batch_id: int, path: str, **loop: Any) -> None:
    iterate_batch(rows, batch_id, path, **loop)


def _keyed(rows: DataFrame, batch_id: int, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    upsert(rows, path, batch_id, keys, order)


SOURCES: dict[str, Source] = {
    "messages": message_batches,
    "json": json_batches,
    "queue": queue_batches,
    "kafka": lambda spark, topic, servers, **o: kafka_messages(spark, servers, topic, **o),
}
#: What a sink does with the rows of one micro-batch, given its number and the sink's options.
SINKS: dict[str, Sink] = {
    "console": _console,
    "parquet": _parquet,
    "stamped": _stamped,
    "keyed": _keyed,
    "text": _text,
    "deliver": _deliver,
    "jdbc": _jdbc,
    "partials": _partials,
    "iterate": _iterate,
}


def validate(spec: JobSpec) -> None:
    """SRC-6: refuse a job that cannot run, before anything starts."""
    if not spec.topic:
        raise ValueError(f"job {spec.name!r} has no source topic")
    if spec.source not in SOURCES:
        raise ValueError(f"unknown source {spec.source!r}, known: {sorted(SOURCES)}")
    if spec.sink is not None and spec.branches:
        raise ValueError(f"job {spec.name!r} has both a sink and branches")
    for sink in [spec.sink or "console", *[b.sink for b in spec.branches.values()]]:
        if sink not in SINKS:
            raise ValueError(f"unknown sink {sink!r}, known: {sorted(SINKS)}")
    for name in spec.branches:
        if not re.fullmatch(r"\w[\w-]*", name):
            raise ValueError(f"not a name of a branch: {name!r}")


def _checkpoint(spark: SparkSession, spec: JobSpec) -> str:
    options = [spec.sink_options] if spec.sink else [b.sink_options for b in spec.branches.values()]
    path = next((o["path"] for o in options if o.get("path")), None)
    return f"{path.rstrip('/')}-checkpoint/{spec.name}" if path else new_path(spark, f"checkpoint-{spec.name}")


#: Column of the kept rows that names their branch.
TAG = "_goes_to"


def write_branches(rows: DataFrame, batch_id: int, branches: Mapping[str, Branch], folder: str) -> None:
    """RT-1, RT-2: hand one micro-batch to several sinks.

    The rows are worked out once and kept below ``folder`` until every branch has stored
    its part, which a marker of the branch and batch says.  A branch that fails does not
    keep the others from theirs; its error fails the batch, and when that is retried only
    branches without a marker run, on the rows that the others have had.
    """
    spark = rows.sparkSession
    # Rows that were kept for other branches do not serve these.
    names_key = hashlib.md5("/".join(sorted(branches)).encode()).hexdigest()
    done, staged = f"{folder}/done/{batch_id}", f"{folder}/rows/{batch_id}/{names_key}"
    missing = sorted(branches.keys() - set(names(spark, done)))
    if not missing:
        return
    if "_SUCCESS" not in names(spark, staged):
        conditions = {f"to-{name}": F.expr(b.where) if isinstance(b.where, str) else b.where for name, b in branches.items()}
        tag_branches(rows, conditions, TAG).write.mode("overwrite").partitionBy(TAG).parquet(staged)
    kept = spark.read.schema(StructType([*rows.schema.fields, StructField(TAG, StringType())])).parquet(staged)
    errors = []
    for name in missing:
        part = kept.filter(F.col(TAG) == f"to-{name}").drop(TAG)
        try:
            SINKS[branches[name].sink](part, batch_id, **branches[name].sink_options)
        except Exception as e:  # the other branches go on
            errors.append((name, e))
        else:
            publish(spark, done, name, "")
    if errors:
        raise RuntimeError(f"batch {batch_id}: branches {[name for name, _ in errors]} failed") from errors[0][1]
    # The markers of the batch stay until the next one is done, as Spark may repeat it.
    for old in (f"{folder}/rows/{batch_id}", f"{folder}/done/{batch_id - 2}"):
        fs, path = filesystem(spark, old)
        fs.delete(path, True)


def start_job(spark: SparkSession, spec: JobSpec) -> StreamingQuery:
    """Start a job in its own session, so its parallelism does not touch other jobs.

    Without a sink the rows are printed. The position is kept in the checkpoint: by
    default beside what the sink stores, under the job's name, so a job that starts again
    goes on where it was; a job that stores nothing begins anew. Batches follow each
    other at once while there is data, and wait ``poll_seconds`` when there is none.
    """
    validate(spec)
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.pollingDelay", f"{spec.poll_seconds}s")
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # A micro-batch stores what it changed; the whole state follows in the background.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set(
        "spark.sql.shuffle.partitions", spec.parallelism or spark.conf.get("spark.sql.shuffle.partitions")
    )
    checkpoint = spec.checkpoint or _checkpoint(spark, spec)
    rows = SOURCES[spec.source](own, spec.topic, **spec.source_options).transform(spec.operator)
    if spec.branches:
        writer = each_batch(rows, lambda batch, i: write_branches(batch, i, spec.branches, f"{checkpoint}-branches"))
    elif spec.sink in (None, "console"):
        writer = print_rows(rows)
    else:
        writer = each_batch(rows, lambda batch, i: SINKS[spec.sink](batch, i, **spec.sink_options))
    writer = writer.outputMode(spec.output_mode).queryName(spec.name)
    writer = writer.option("checkpointLocation", checkpoint)
    if spec.until_drained:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime="0 seconds").start()


def start_jobs(spark: SparkSession, specs: Sequence[JobSpec]) -> list[StreamingQuery]:
    """ST-5: start independent jobs; all are checked before the first one starts."""
    for spec in specs:
        validate(spec)
    return [start_job(spark, spec) for spec in specs]


def drain(query: StreamingQuery, timeout: int = 600) -> None:
    """Wait until an ``until_drained`` job has read all that is there."""
    try:
        if not query.awaitTermination(timeout):
            raise TimeoutError(f"job {query.name!r} did not end in {timeout} s")
    finally:
        query.stop()


def drain_queue(spark: SparkSession, spec: JobSpec, timeout: int = 600) -> None:
    """Run an ``until_drained`` job of a queue until its consumer has been handed every batch.

    Each run ends with the micro-batch that it began with, so the job is started again
    as long as batches are pending.
    """
    while True:
        drain(start_job(spark, spec), timeout)
        if not pending(spark, spec.topic, spec.source_options["consumer"]):
            return
