"""Iteration over a stream, with a bound in time.

Spark has no feedback edge between streams, so rows that are not finished are a table
between micro-batches: each batch takes them up with its new rows, runs some steps of
all of them, and stores what is finished, what goes on, and what has gone on for too
long, each row once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.iterate import Step, run_steps
from tidemark.storage import filesystem, names, publish

#: Fixed value: milliseconds after which a row that still goes on comes out as it is.
FEEDBACK_TIMEOUT_MS = 5000

#: Where a row of a batch is: finished, out of time, or to be taken up by the next batch.
DONE, EXPIRED, PENDING = "done", "expired", "pending"
PLACE, SINCE = "_place", "_since"
#: Folder of rows that were finished after the last batch, and the file that says so.
APART, FINISHED = "_apart", "finished"


def _pending(spark: SparkSession, path: str, batch_id: int, schema: StructType) -> DataFrame | None:
    """The rows that a batch has left to the next one; None without any, or when they were finished apart."""
    folder = f"{path}/batch_id={batch_id}"
    if "_SUCCESS" not in names(spark, folder) or f"{PLACE}={PENDING}" not in names(spark, folder) or _finished(spark, path, batch_id):
        return None
    return spark.read.schema(schema).parquet(f"{folder}/{PLACE}={PENDING}")


def _finished(spark: SparkSession, path: str, batch_id: int) -> bool:
    return FINISHED in names(spark, f"{path}/{APART}/batch_id={batch_id}")


def _placed(active: DataFrame, now: int, timeout_ms: int, steps: int, loop: dict) -> DataFrame:
    """The rows after some steps, and where they belong."""
    ran = run_steps(active, steps=steps, **loop)
    expired = F.col(SINCE) + F.lit(timeout_ms) <= F.lit(now)
    place = F.when(F.col("_more") == 0, DONE).when(expired, EXPIRED).otherwise(PENDING)
    return ran.withColumn(PLACE, place).select(*active.columns, PLACE)


def iterate_batch(
    rows: DataFrame, batch_id: int, path: str, state: Sequence[str], step: Step, again: Callable[[Column], Column],
    steps_per_batch: int = 32, timeout_ms: int = FEEDBACK_TIMEOUT_MS,
) -> None:
    """Run up to ``steps_per_batch`` steps of new and pending rows and store them below ``path``.

    A row whose condition still holds ``timeout_ms`` after it arrived comes out marked as
    expired, with the state it has; a row that is finished by the same steps is not. A retry
    of a batch finds what the batch before left and replaces its own rows.
    """
    spark, now = rows.sparkSession, int(time.time() * 1000)
    active = rows.withColumn(SINCE, F.lit(now).cast("bigint"))
    pending = _pending(spark, path, batch_id - 1, active.schema)
    if pending is not None:
        active = active.unionByName(pending)
    loop = {"state": state, "step": step, "again": again}
    _placed(active, now, timeout_ms, steps_per_batch, loop).write.mode("overwrite").partitionBy(PLACE).parquet(f"{path}/batch_id={batch_id}")
    # What the batch before left has been taken up; a retry of this one still needs it.
    fs, taken = filesystem(spark, f"{path}/batch_id={batch_id - 2}/{PLACE}={PENDING}")
    fs.delete(taken, True)


def _last_batch(spark: SparkSession, path: str) -> int | None:
    found = [int(name.removeprefix("batch_id=")) for name in names(spark, path) if name.startswith("batch_id=")]
    return max(found, default=None)


def finish_pending(
    spark: SparkSession, path: str, state: Sequence[str], step: Step, again: Callable[[Column], Column],
    steps_per_round: int = 32, timeout_ms: int = FEEDBACK_TIMEOUT_MS,
) -> None:
    """Iterate what the last batch has left until it is finished or out of time, while no job runs.

    For a stream that has no more rows to bring the next batch about. It counts once it is
    whole; if it fails, the rows are pending as before.
    """
    last = _last_batch(spark, path)
    if last is None or _finished(spark, path, last):
        return
    loop, folder = {"state": state, "step": step, "again": again}, f"{path}/{APART}/batch_id={last}"
    whole = spark.read.parquet(path).drop("batch_id", PLACE)
    active, round_ = _pending(spark, path, last, whole.schema), 0
    while active is not None and not active.isEmpty():
        target = f"{folder}/_round={round_}"
        _placed(active, int(time.time() * 1000), timeout_ms, steps_per_round, loop).write.mode("overwrite").partitionBy(PLACE).parquet(target)
        left = f"{PLACE}={PENDING}" in names(spark, target)
        active, round_ = spark.read.schema(whole.schema).parquet(f"{target}/{PLACE}={PENDING}") if left else None, round_ + 1
    publish(spark, folder, FINISHED, str(round_))


def read_iterated(spark: SparkSession, path: str) -> DataFrame:
    """Rows that have come out, each once, with ``expired`` for those that were out of time."""
    rows = spark.read.parquet(path)
    apart = [f"{path}/{APART}/{name}" for name in names(spark, f"{path}/{APART}") if _finished(spark, path, int(name.removeprefix("batch_id=")))]
    rounds = [f"{folder}/{name}" for folder in apart for name in names(spark, folder) if name.startswith("_round=")]
    if rounds:
        schema = StructType([f for f in rows.schema.fields if f.name != "batch_id"])
        rows = rows.drop("batch_id").unionByName(spark.read.schema(schema).option("basePath", f"{path}/{APART}").parquet(*rounds).select(schema.names))
    done = rows.filter(F.col(PLACE).isin(DONE, EXPIRED)).withColumn("expired", F.col(PLACE) == EXPIRED)
    return done.select([c for c in done.columns if c not in ("batch_id", PLACE, SINCE)])


def pending_rows(spark: SparkSession, path: str) -> int:
    """Rows that the next batch will take up."""
    last = _last_batch(spark, path)
    pending = None if last is None else _pending(spark, path, last, spark.read.parquet(path).drop("batch_id", PLACE).schema)
    return 0 if pending is None else pending.count()
