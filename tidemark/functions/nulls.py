"""Defaults and the null sentinels of the fact table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the fact table stores in place of NULL.
NULL_DATETIME = "1970-01-01 00:00:00"
NULL_DATE = "1970-01-01"
NULL_ACT_DATETIME = "1970-01-01 06:28:16"

NOT_SET = "(not set)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_default(c: Column | str, default: str = NOT_SET) -> Column:
    """F-17: the text, or the default when it is NULL or empty."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def encode_null(c: Column | str, sentinel: str = NULL_DATETIME) -> Column:
    """F-19: replace NULL by a sentinel of the same text form."""
    return F.coalesce(_col(c).cast("string"), F.lit(sentinel))


def decode_null(c: Column | str, sentinel: str = NULL_DATETIME) -> Column:
    """F-19: turn the sentinel back into NULL."""
    return F.nullif(_col(c), F.lit(sentinel))
