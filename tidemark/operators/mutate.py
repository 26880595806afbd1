"""Predicate deletes and updates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """MU-1: the rows for which the predicate is not true."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def update_where(df: DataFrame, predicate: Column, changes: Mapping[str, Column | str]) -> DataFrame:
    """MU-2: set columns where the predicate is true.

    A string is a SQL expression over the old row, so text needs its own quotes.
    Unknown columns are an error.
    """
    unknown = set(changes) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    hit = F.coalesce(predicate, F.lit(False))
    new = {
        c: F.when(hit, (F.expr(v) if isinstance(v, str) else v).cast(df.schema[c].dataType)).otherwise(F.col(c))
        for c, v in changes.items()
    }
    return df.withColumns(new)
