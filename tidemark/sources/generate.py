"""Generated input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How many pairs, and the exclusive upper bound of their numbers.
PAIRS = 1000
MAX_START = 50


def pair_text(a: Column, b: Column) -> Column:
    """The text form ``"a, b"`` of a pair."""
    return F.concat_ws(", ", a.cast("string"), b.cast("string"))


def number_pairs(spark: SparkSession, n: int = PAIRS, seed: int = 42) -> DataFrame:
    """SRC-3: ``n`` pairs as text; a hash of the row id keeps retries repeatable."""

    def draw(salt: int) -> Column:
        return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(MAX_START - 1)) + 1

    return spark.range(n).select(pair_text(draw(1), draw(2)).alias("value"))


def pair_stream(spark: SparkSession, rows_per_second: int = 50, seed: int = 42) -> DataFrame:
    """SRC-3 as an endless stream."""

    def draw(salt: int) -> Column:
        return F.pmod(F.xxhash64(F.col("value"), F.lit(seed), F.lit(salt)), F.lit(MAX_START - 1)) + 1

    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return rate.select(pair_text(draw(1), draw(2)).alias("value"))
