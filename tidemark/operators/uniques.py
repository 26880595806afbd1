"""Unique visitors with day-scoped keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAFFIC_KEYS = ("date", "plat", "agent_type", "website")
CLICK_KEYS = ("date", "plat", "agent_type", "click_category", "dime")
PUSH_KEYS = ("date", "plat", "agent_type", "detail_id")


def first_seen(
    df: DataFrame,
    keys: Sequence[str],
    visit: str = "visit_id",
    order: Sequence[str] = ("req_time", "event_id"),
    dedupe: bool = True,
) -> DataFrame:
    """The ids that are new for their key, with the last ``order`` column of their first row.

    The first row is that of the earliest time, of equal times that of the smallest id.

    A plain minimum per (key, id): repeats are merged before the shuffle, so a busy
    key or visitor costs no more than a quiet one. With ``dedupe`` off every row is
    returned, as without a state store (UV-6).
    """
    columns = [*keys, visit]
    if not dedupe:
        return df.select(*columns, order[-1])
    first = F.min(F.struct(*order)).getField(order[-1])
    return df.groupBy(*columns).agg(first.alias(order[-1]))


def traffic_uv(df: DataFrame, **options) -> DataFrame:
    """UV-1: ids first seen per date, platform, device and page."""
    return first_seen(df, TRAFFIC_KEYS, **options)


def click_uv(df: DataFrame, **options) -> DataFrame:
    """UV-2: ids first seen per date, platform, device, click category and dimension."""
    return first_seen(df, CLICK_KEYS, **options)


def push_app_uv(df: DataFrame, **options) -> DataFrame:
    """UV-3: ids first seen per date, platform, device and push detail."""
    return first_seen(df, PUSH_KEYS, **options)


def uv_sketches(df: DataFrame, keys: Sequence[str], visit: str = "visit_id", lg_k: int = 14) -> DataFrame:
    """UV-4: one mergeable HLL sketch of the ids per key."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(visit, lg_k).alias("sketch"))


def uv_from_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """UV-4: approximate unique ids of coarser keys, without reading the rows again."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv_estimate")
    )
