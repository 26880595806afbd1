"""Small row reshapings."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The comparison signs a mutation predicate may use.
COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def identity(df: DataFrame) -> DataFrame:
    """DEC-12: the rows as they are."""
    return df.select("*")


def parse_pair(df: DataFrame, value: str = "value") -> DataFrame:
    """DEC-13: text ``"a, b"`` to ``(a, b)``; text that is not two integers gives NULLs."""
    parts = F.split(value, ",")
    two = F.size(parts) == 2

    def number(i: int) -> Column:
        return F.when(two, F.trim(F.get(parts, F.lit(i))).try_cast("bigint"))

    return df.withColumns({"a": number(0), "b": number(1)}).drop(value)


def pair_result(df: DataFrame, n: str = "n") -> DataFrame:
    """DEC-14: ``(pair struct, n)``."""
    return df.select(F.struct("a", "b").alias("pair"), n)


def payload(df: DataFrame, column: str = "data") -> DataFrame:
    """DEC-15: drop the routing tag and keep the payload."""
    return df.select(column)


Condition = tuple[str, str, object]


def all_of(conditions: Iterable[Condition | Column]) -> Column:
    """DEC-16: AND of ``(column, sign, literal)`` terms and nested predicates."""
    return _combine(operator.and_, conditions, True)


def any_of(conditions: Iterable[Condition | Column]) -> Column:
    """DEC-16: OR of ``(column, sign, literal)`` terms and nested predicates."""
    return _combine(operator.or_, conditions, False)


def _combine(join, conditions: Iterable[Condition | Column], neutral: bool) -> Column:
    terms: Sequence[Column] = [
        c if isinstance(c, Column) else COMPARISONS[c[1]](F.col(c[0]), F.lit(c[2]))
        for c in conditions
    ]
    return reduce(join, terms) if terms else F.lit(neutral)
