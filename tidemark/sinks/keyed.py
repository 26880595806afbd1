"""Key-value upsert.

Every micro-batch adds the last row of each of its keys under its own batch number,
and a read takes the newest row per key. So a batch costs what it holds, not what
the table holds. ``compact`` folds the batches up to one of them into a table that is
bucketed and sorted by key; a read then joins the batches since, which are shuffled, to
the buckets, which are not.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.storage import filesystem, names, publish, qualified

FOLDED = "_folded"
#: Marks a row of the batches beside one of the fold.
NEWER = "_newer"


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def upsert(df: DataFrame, path: str, batch_id: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Store one batch and give back its rows. A retry replaces the same batch."""
    last_per_key(df, keys, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return df


def folds(spark: SparkSession, path: str) -> dict[int, dict]:
    """What is known of each complete fold, by the last batch in it."""
    found = [name for name in names(spark, f"{path}/{FOLDED}") if name.endswith(".json")]
    if not found:
        return {}
    rows = spark.read.text([f"{path}/{FOLDED}/{name}" for name in found], wholetext=True).collect()
    return {fold["last_batch"]: fold for fold in (json.loads(r.value) for r in rows)}


def _named(spark: SparkSession, path: str, data: str) -> tuple[str, str]:
    """Where a fold is, and its name in the catalog."""
    location = qualified(spark, f"{path}/{FOLDED}/{data}")
    return location, f"tidemark_fold_{hashlib.md5(location.encode()).hexdigest()}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fold_table(spark: SparkSession, path: str, fold: dict) -> DataFrame:
    """A fold with its buckets, which Spark knows of tables only: so the session's catalog names it."""
    location, name = _named(spark, path, fold["data"])
    if not spark.catalog.tableExists(name):
        schema = StructType.fromJson(fold["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{key}`" for key in fold["keys"])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {fold['buckets']} BUCKETS LOCATION {_quoted(location)}")
    return spark.table(name)


def _batches(spark: SparkSession, path: str, after: int, last_batch: int | None) -> DataFrame | None:
    """The batches after a fold, and no others listed."""
    found = [int(name.removeprefix("batch_id=")) for name in names(spark, path) if name.startswith("batch_id=")]
    wanted = [f"{path}/batch_id={n}" for n in sorted(found) if n > after and (last_batch is None or n <= last_batch)]
    return spark.read.option("basePath", path).parquet(*wanted) if wanted else None


def _without_key(keys: Sequence[str]):
    return reduce(lambda a, b: a | b, [F.col(f"`{key}`").isNull() for key in keys])


def read_latest(spark: SparkSession, path: str, keys: Sequence[str], last_batch: int | None = None) -> DataFrame:
    """The current row of each key; with ``last_batch`` as it was after that batch. NULL is a key like any other.

    The newest fold is joined where it lies, by bucket; only the batches after it are
    shuffled. Keys with a NULL, which no join finds, are grouped.
    """
    known = {n: fold for n, fold in folds(spark, path).items() if last_batch is None or n <= last_batch}
    after = max(known, default=-1)
    newer = _batches(spark, path, after, last_batch)
    if newer is not None:
        newer = last_per_key(newer, keys, ["batch_id"]).drop("batch_id")
    if not known:
        if newer is None:
            raise ValueError(f"{path} holds no batch" + ("" if last_batch is None else f" up to {last_batch}"))
        return newer
    base = _fold_table(spark, path, known[after])
    if newer is None:
        return base
    newer = newer.select(*base.columns)
    added = newer.filter(~_without_key(keys)).withColumn(NEWER, F.lit(True))
    kept = base.filter(~_without_key(keys)) if known[after]["nulls"] else base
    joined = kept.join(added, [kept[key] == added[key] for key in keys], "full_outer")
    rows = joined.select(*[F.when(added[NEWER], added[c]).otherwise(kept[c]).alias(c) for c in base.columns])
    # A key of the batches is newer than the same key of the fold.
    nulls = newer.filter(_without_key(keys)).withColumn(NEWER, F.lit(1))
    if known[after]["nulls"]:
        nulls = nulls.unionByName(base.filter(_without_key(keys)).withColumn(NEWER, F.lit(0)))
    return rows.unionByName(last_per_key(nulls, keys, [NEWER]).drop(NEWER))


def compact(spark: SparkSession, path: str, keys: Sequence[str], last_batch: int, buckets: int | None = None) -> None:
    """Fold the batches up to ``last_batch`` into one table; later ones stay as they are.

    It has ``buckets`` files, by default as many as the fold before it, or as the session
    has shuffle partitions; choose it so that one is a few hundred megabytes.  The fold
    counts once it is complete; see ``remove_folded`` for the batches in it.
    """
    done = {n: fold for n, fold in folds(spark, path).items() if n <= last_batch}
    before = done.get(max(done, default=-1))
    if last_batch in done:
        return
    buckets = buckets or (before["buckets"] if before else int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = read_latest(spark, path, keys, last_batch)
    data = f"upto-{last_batch:012d}-{buckets}"
    location, name = _named(spark, path, data)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = rows.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", location).format("parquet").saveAsTable(name)
    nulls = not spark.table(name).filter(_without_key(keys)).isEmpty()
    fold = {"last_batch": last_batch, "data": data, "buckets": buckets, "keys": list(keys), "nulls": nulls, "schema": rows.schema.jsonValue()}
    publish(spark, f"{path}/{FOLDED}", f"{data}.json", json.dumps(fold))


def remove_folded(spark: SparkSession, path: str) -> int:
    """Delete the batches of the newest fold, and the folds before it; returns how many batches went.

    Call it when no reader of before that fold is left, and the stream has committed its batches.
    """
    done = folds(spark, path)
    last = max(done, default=-1)
    old = [name for name in names(spark, path) if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= last]
    gone = [fold["data"] for n, fold in done.items() if n < last]
    earlier = [f"{FOLDED}/{data}" for data in gone]
    for data in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_named(spark, path, data)[1]}")
    for name in [*old, *[f"{data}.json" for data in earlier], *earlier]:
        fs, target = filesystem(spark, f"{path}/{name}")
        fs.delete(target, True)
    return len(old)
