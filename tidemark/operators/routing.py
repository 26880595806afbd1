"""Splitting one flow into named ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_by_value(df: DataFrame, values: Sequence[str], column: str = "topic") -> dict[str, DataFrame]:
    """RT-1 and RT-2: one branch per value; each is a pushed-down filter."""
    return {v: df.filter(F.col(column) == v) for v in values}


def split_by_predicate(df: DataFrame, branches: Mapping[str, Column]) -> dict[str, DataFrame]:
    """RT-3: one branch per predicate; a row may be in several, NULL is in none."""
    return {name: df.filter(F.coalesce(p, F.lit(False))) for name, p in branches.items()}


def split_in_two(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """RT-3: the rows where the predicate holds, and all the others."""
    holds = F.coalesce(predicate, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def tag_branches(df: DataFrame, branches: Mapping[str, Column], column: str = "branch") -> DataFrame:
    """RT-3 in one pass: one output row per branch that a row matches.

    Use it to write all branches with ``partitionBy("branch")`` in one scan.
    """
    names = F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(n)) for n, p in branches.items()])
    return df.withColumn(column, F.explode(F.array_compact(names)))
