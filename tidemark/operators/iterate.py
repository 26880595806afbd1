"""Iteration until a predicate holds."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from tidemark.session import new_path

#: Steps of the longest round.
LONGEST_ROUND = 1024

Step = Callable[[Column], dict[str, Column]]


def run_steps(df: DataFrame, state: Sequence[str], step: Step, again: Callable[[Column], Column], steps: int) -> DataFrame:
    """Up to ``steps`` steps of each row inside a single expression, with no shuffle; ``_more`` is 1 for rows that go on."""
    fields = {f: df.schema[f].dataType.simpleString() for f in state}
    kept = [c for c in df.columns if c not in fields]

    def packed(values: dict[str, Column], more: Column) -> Column:
        typed = [values[f].cast(kind).alias(f) for f, kind in fields.items()]
        return F.struct(F.struct(*typed).alias("s"), more.alias("more"))

    def advance(acc: Column, _: Column) -> Column:
        old = {f: acc.s[f] for f in fields}
        stepped = packed({**old, **step(acc.s)}, F.lit(True))
        more = F.coalesce(again(stepped.s), F.lit(False))
        return F.when(acc.more, F.struct(stepped.s.alias("s"), more.alias("more"))).otherwise(acc)

    start = packed({f: F.col(f) for f in fields}, F.lit(True))
    ran = df.select(*kept, F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, advance).alias("_it"))
    return ran.select(*kept, "_it.s.*", F.col("_it.more").cast("int").alias("_more"))


def iterate(
    df: DataFrame,
    state: Sequence[str],
    step: Step,
    again: Callable[[Column], Column],
    steps_per_round: int = 32,
    max_rounds: int | None = None,
) -> DataFrame:
    """Apply ``step`` to each row at least once and as long as ``again`` holds.

    ``step`` gets the state as a struct column and returns its new fields; ``again``
    gets the struct after a step. One round runs a number of steps of a row inside a
    single expression, with no shuffle: ``steps_per_round`` at first, twice as many in
    each later round up to 1024. It is written to shared storage, finished rows apart
    from the others, and the next round reads only the others. There is no limit on the
    rounds unless the caller gives one.
    """
    spark = df.sparkSession
    active, root, steps = df, new_path(spark, "iterate"), steps_per_round
    for number in itertools.count():
        if number == max_rounds:
            raise RuntimeError(f"rows still iterate after {max_rounds} rounds")
        ran = run_steps(active, state, step, again, steps)
        path = f"{root}/_round={number}"
        ran.write.partitionBy("_more").parquet(path)
        active = spark.read.schema(ran.schema).parquet(path).filter("_more = 1").select(df.columns)
        if active.isEmpty():
            break
        steps = max(steps_per_round, min(2 * steps, LONGEST_ROUND))
    # All rounds are read at once, however many there were.
    stored = StructType([*ran.schema.fields]).add("_round", IntegerType())
    return spark.read.schema(stored).parquet(root).filter("_more = 0").select(df.columns)


def sum_pairs(df: DataFrame, limit: int = 100) -> DataFrame:
    """IT-2: count the steps ``(x, y) -> (y, x + y)`` until x or y reaches ``limit``.

    Needs integer columns ``a, b``; adds ``n``.
    """
    return iterate(pair_start(df), **pair_steps(limit)).drop("x", "y")


def pair_start(df: DataFrame) -> DataFrame:
    """IT-2: pairs with the state that they begin with."""
    zero = F.lit(0).cast("bigint")
    return df.withColumns({"x": F.col("a").cast("bigint"), "y": F.col("b").cast("bigint"), "n": zero})


def pair_steps(limit: int = 100) -> dict:
    """IT-2: the state, the step and the condition to go on."""
    return {
        "state": ["x", "y", "n"],
        "step": lambda s: {"x": s.y, "y": s.x + s.y, "n": s.n + 1},
        "again": lambda s: (s.x < limit) & (s.y < limit),
    }
