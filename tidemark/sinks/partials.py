"""Counts and sketches of a stream as mergeable partial rows.

A micro-batch stores one row for each key and day: the number of its rows and a sketch
of each kind of id.  Rows of a key merge in any order, so a summary at any coarser key
is a read; nothing is kept in the stream's state.  Days that are past are folded into one
row per key; late rows of such a day are partial rows again, which the read adds.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import filesystem, names, publish

FOLDED = "_folded"
#: Days that a fold leaves open, as late rows may still come.
OPEN_DAYS = 2
#: A sketch has 2^LG_K registers: up to some hundred ids it counts exactly, beyond that with
#: a standard error of 0.8 / sqrt(2^LG_K), about 1.3 %.
LG_K = 12


def write_partials(
    df: DataFrame, path: str, batch_id: int, keys: Sequence[str], distinct: Mapping[str, str], day: str = "req_date", lg_k: int = LG_K
) -> DataFrame:
    """Store the partial rows of one micro-batch and give back its rows. A retry replaces the same batch.

    ``distinct`` names a count of distinct ids and the column of the ids.
    """
    sketches = [F.hll_sketch_agg(column, lg_k).alias(name) for name, column in distinct.items()]
    rows = df.groupBy(day, *keys).agg(F.count("*").alias("n_rows"), *sketches)
    rows.write.mode("overwrite").partitionBy(day).parquet(f"{path}/batch_id={batch_id}")
    return df


def _folds(spark: SparkSession, path: str) -> list[dict]:
    """The complete folds, in their order."""
    found = [name for name in names(spark, f"{path}/{FOLDED}") if name.endswith(".json")]
    if not found:
        return []
    rows = spark.read.text([f"{path}/{FOLDED}/{name}" for name in found], wholetext=True).collect()
    return sorted((json.loads(r.value) for r in rows), key=lambda fold: fold["number"])


def _inside(fold: dict, day: str) -> Column:
    """Whether a partial row is part of a fold."""
    return (F.col("batch_id") <= fold["last_batch"]) & (F.col(day) <= F.lit(fold["last_day"]).cast("date"))


def _partials(spark: SparkSession, path: str, day: str) -> DataFrame:
    """The newest fold and the partial rows that are not in it; both filters prune directories."""
    rows, done = spark.read.parquet(path), _folds(spark, path)
    if not done:
        return rows.drop("batch_id")
    fold = done[-1]
    folded = spark.read.schema(rows.drop("batch_id").schema).parquet(f"{path}/{FOLDED}/{fold['data']}")
    return rows.filter(~_inside(fold, day)).drop("batch_id").unionByName(folded)


def _merged(rows: DataFrame, keys: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"), *[F.hll_union_agg(name).alias(name) for name in distinct])


def read_partials(spark: SparkSession, path: str, keys: Sequence[str], distinct: Sequence[str], day: str = "req_date") -> DataFrame:
    """The keys, ``n_rows`` and each of the distinct counts; ``keys`` may be fewer than were stored, and hold the day or not."""
    merged = _merged(_partials(spark, path, day), keys, distinct)
    return merged.select(*keys, "n_rows", *[F.hll_sketch_estimate(name).alias(name) for name in distinct])


def fold_days(
    spark: SparkSession, path: str, last_batch: int, keys: Sequence[str], distinct: Sequence[str], day: str = "req_date", open_days: int = OPEN_DAYS
) -> str | None:
    """Fold the rows of past days in batches up to ``last_batch`` to one per key; returns the last of these days.

    The newest ``open_days`` days stay as they are.  ``last_batch`` has to be a batch that
    the stream has committed. Directories that an earlier fold holds are removed.
    """
    done = _folds(spark, path)
    newest = spark.read.parquet(path).agg(F.max(day)).head()[0]
    if newest is None:
        return None
    last_day = spark.range(1).select(F.date_sub(F.lit(newest), open_days).cast("string")).head()[0]
    if done:
        # A later fold holds all that an earlier one does.
        last_day, last_batch = max(last_day, done[-1]["last_day"]), max(last_batch, done[-1]["last_batch"])
        if (last_day, last_batch) == (done[-1]["last_day"], done[-1]["last_batch"]):
            return last_day
    fold = {"number": len(done) and done[-1]["number"] + 1, "last_day": last_day, "last_batch": last_batch}
    fold["data"] = f"fold-{fold['number']:08d}"
    rows = spark.read.parquet(path).filter(_inside(fold, day))
    if done:
        before = spark.read.schema(rows.drop("batch_id").schema).parquet(f"{path}/{FOLDED}/{done[-1]['data']}")
        rows = rows.filter(~_inside(done[-1], day)).drop("batch_id").unionByName(before)
    merged = _merged(rows, [day, *keys], distinct)
    merged.write.mode("overwrite").partitionBy(day).parquet(f"{path}/{FOLDED}/{fold['data']}")
    publish(spark, f"{path}/{FOLDED}", f"{fold['data']}.json", json.dumps(fold))
    if done:
        _remove(spark, path, day, done)
    return last_day


def _remove(spark: SparkSession, path: str, day: str, done: Sequence[dict]) -> None:
    """Delete what the last fold but one was made of, and the folds before it; readers that know of it go on."""
    fold = done[-1]
    old = [f"{FOLDED}/{f['data']}{end}" for f in done[:-1] for end in (".json", "")]
    for batch in names(spark, path):
        if batch.startswith("batch_id=") and int(batch.removeprefix("batch_id=")) <= fold["last_batch"]:
            days = [d for d in names(spark, f"{path}/{batch}") if d.startswith(f"{day}=")]
            old += [f"{path}/{batch}/{d}".removeprefix(f"{path}/") for d in days if d.removeprefix(f"{day}=") <= fold["last_day"]]
    for name in old:
        fs, target = filesystem(spark, f"{path}/{name}")
        fs.delete(target, True)
