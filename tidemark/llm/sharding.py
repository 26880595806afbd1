"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0 to N-1 in an order that depends on their content alone.  A keyed
permutation of the numbers, made of Feistel rounds on a rectangle just larger than N
with cycle walking back below N, is the shuffle: position p goes to shard ``p % shards``
and slot ``p div shards``.  Both follow from a row's number, N and the seed, so counts
differ by one at most and the slots of a shard have no gaps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Prime modulus of the round function; products of two residues fit a long.
PRIME = 2147483647
MULTIPLIER = 48271
ROUNDS = 6


def round_keys(seed: int) -> list[tuple[int, int]]:
    """Two residues for each round, by a multiplicative generator started from the seed."""
    state, keys = (seed * 69621 + 12345) % PRIME, []
    for _ in range(2 * ROUNDS):
        state = (state * MULTIPLIER + 11) % PRIME
        keys.append(state)
    return list(zip(keys[::2], keys[1::2], strict=True))


def sides(n: int) -> tuple[int, int]:
    """Sides of a near-square rectangle of n cells and at most one column more."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _div(x: Column, by: int) -> Column:
    return F.call_function("div", x, F.lit(by).cast("long"))


def _rounds(x: Column, n: int, seed: int) -> Column:
    """A permutation of the cells of the rectangle."""
    a, b = sides(n)
    keys = F.array(
        *[
            F.struct(*[F.lit(v).cast("long").alias(name) for name, v in (("k", k), ("c", c), ("m", b if i % 2 else a))])
            for i, (k, c) in enumerate(round_keys(seed))
        ]
    )

    def step(s: Column, key: Column) -> Column:
        mixed = ((s.r + key.k) % PRIME) * ((s.r + key.c) % PRIME) % PRIME
        mixed = (mixed * MULTIPLIER + key.c) % PRIME
        return F.struct(s.r.alias("l"), ((s.l + mixed) % key.m).alias("r"))

    return F.aggregate(keys, F.struct(_div(x, b).alias("l"), (x % b).alias("r")), step, lambda s: s.l * b + s.r)


def with_position(numbered: DataFrame, n: int, seed: int, row: str = "row_number") -> DataFrame:
    """Add ``position``, the place of each row number below n in the shuffle.

    A walk leaves the numbers from n up after as many steps as there are of them, at
    most; only the few rows that the rounds put there walk on at all.
    """
    a, b = sides(n)
    first = numbered.withColumn("position", _rounds(F.col(row), n, seed))
    if a * b == n or n == 0:
        return first
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(a * b - n)),
        F.col("position"),
        lambda x, _: F.when(x < n, x).otherwise(_rounds(x, n, seed)),
    )
    return first.withColumn("position", F.when(F.col("position") < n, F.col("position")).otherwise(walked))


def numbered_rows(docs: DataFrame, id_col: str, text_col: str, bucket_rows: int) -> tuple[DataFrame, int]:
    """doc_id, size, text_crc32 and row_number of every row, and the number of rows.

    Equal rows are counted first and numbered as one run, so no repeated key meets in a
    task; the order within a bucket is by content, and buckets follow each other by the
    sums of their counts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    groups = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("copies"))
    )
    n = groups.agg(F.sum("copies")).head()[0] or 0
    buckets = max(1, -(-n // bucket_rows))
    place = (F.coalesce(F.pmod(F.col("doc_id"), F.lit(PRIME)), F.lit(0)) * MULTIPLIER + F.col("text_crc32")) % PRIME % buckets
    groups = groups.withColumn("bucket", place)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.groupBy("bucket").agg(F.sum("copies").alias("of_bucket")).select("bucket", F.coalesce(F.sum("of_bucket").over(before), F.lit(0)).alias("bucket_start"))
    within = Window.partitionBy("bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    runs = groups.withColumn("run_start", F.coalesce(F.sum("copies").over(within), F.lit(0))).join(offsets, "bucket")
    # A long run is dealt out in chunks before it is unfolded.
    chunk = 1 << 16
    chunks = runs.withColumn("chunk_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(chunk).cast("long"))))
    chunks = chunks.repartition("bucket", "doc_id", "chunk_start")
    last = F.least(F.col("chunk_start") + chunk, F.col("copies")) - 1
    rows = chunks.withColumn("copy", F.explode(F.sequence(F.col("chunk_start"), last)))
    return rows.select("doc_id", "size", "text_crc32", (F.col("bucket_start") + F.col("run_start") + F.col("copy")).alias("row_number")), n


def feistel_shards(
    docs: DataFrame,
    n_shards: int = 8,
    seed: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 20_000,
) -> DataFrame:
    """Shard and slot of every row, under the law ``rows``.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law, shard, slot, grown_shard
    (null, as the law is not ``key``), row_number and position.  Null texts count as
    empty, with CRC 0; null ids come first in their bucket; repeated rows get numbers of
    their own; an empty table gives no rows.  Other columns are not read.
    """
    rows, n = numbered_rows(docs, id_col, text_col, bucket_rows)
    placed = with_position(rows, n, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (F.col("position") % n_shards).cast("int").alias("shard"),
        _div(F.col("position"), n_shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
        "position",
    )
