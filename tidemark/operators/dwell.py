"""Page dwell time, in event-time order.

A visit's state lives for one half-hour slot. Each event that comes later than the
one before it credits the time between them to the page that was open, under the
``sign`` of that page's view: the time at which the view was opened.

Of a second only three things matter: its first event, which triggers the increment, the
page of its last, which is open afterwards, and whether it holds several pages, because
one was opened then. So a second becomes one row, on the map side where possible, and a
visit in a slot has no more rows than the slot has seconds, however many events, pages
and channels it has.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.nulls import or_default
from tidemark.functions.times import slot_start

VISIT_KEYS = ("plat", "agent_type", "visit_id")


def with_slot(df: DataFrame, width: int = 1800, req_time: str = "req_time") -> DataFrame:
    """DW-1: add ``slot``, the start of the event's half hour."""
    return df.withColumn("slot", slot_start(req_time, width))


def _seconds(df: DataFrame, width: int, keys: Sequence[str]) -> DataFrame:
    """Each second of a visit: its first event, its last page, and whether it has several."""
    named = F.count("website")
    several = (F.min("website") != F.max("website")) | ((named > 0) & (named < F.count("*")))
    return (
        with_slot(df, width)
        .groupBy(*keys, "slot", "req_time")
        .agg(
            F.min(F.struct("event_id", "channel", "website")).alias("first"),
            F.max(F.struct("event_id", "website")).alias("last"),
            F.coalesce(several, F.lit(False)).alias("several"),
        )
    )


def _with_views(df: DataFrame, width: int, keys: Sequence[str]) -> DataFrame:
    """Add to each second the page, sign and time that were current before it."""
    visit = Window.partitionBy(*keys, "slot").orderBy("req_time")
    earlier = visit.rowsBetween(Window.unboundedPreceding, -1)
    changed = ~F.col("page_before").eqNullSafe(F.col("first.website"))
    opened = F.col("time_before").isNull() | F.col("several") | changed
    return (
        _seconds(df, width, keys)
        .withColumns(
            {
                "page_before": F.lag("last.website").over(visit),
                "time_before": F.lag("req_time").over(visit),
            }
        )
        .withColumn("opened", F.when(opened, F.col("req_time")))
        .withColumn("sign_before", F.max("opened").over(earlier))
        .withColumns({"event_id": F.col("first.event_id"), "channel": F.col("first.channel")})
    )


def dwell_rows(
    df: DataFrame, width: int = 1800, keys: Sequence[str] = VISIT_KEYS
) -> DataFrame:
    """DW-2, DW-4, DW-6: one increment per event that closes or extends a view.

    Needs ``event_id, channel, website, req_time`` and the keys. ``event_id`` and
    ``channel`` of a result row are those of the event that triggered it.
    """
    return (
        _with_views(df, width, keys)
        .filter(F.col("req_time") > F.col("time_before"))
        .select(
            "event_id",
            *keys,
            "slot",
            or_default("channel").alias("channel"),
            F.col("page_before").alias("website"),
            F.col("sign_before").alias("sign"),
            (F.col("req_time") - F.col("time_before")).alias("view_time"),
        )
    )


def dwell_totals(
    df: DataFrame, width: int = 1800, keys: Sequence[str] = VISIT_KEYS
) -> DataFrame:
    """DW-3: total time per view. Groups inside the visits, so it adds no shuffle."""
    return (
        dwell_rows(df, width, keys)
        .groupBy(*keys, "slot", "website", "sign")
        .agg(F.sum("view_time").alias("view_time"))
    )


def latest_view(
    df: DataFrame, width: int = 1800, keys: Sequence[str] = VISIT_KEYS
) -> DataFrame:
    """DW-7: the page and time of the last event per visit and slot."""
    order = F.struct("req_time", "event_id")
    return (
        with_slot(df, width)
        .groupBy(*keys, "slot")
        .agg(F.max_by("website", order).alias("website"), F.max("req_time").alias("req_time"))
    )


def nearest_view(
    probes: DataFrame,
    views: DataFrame,
    width: int = 1800,
    keys: Sequence[str] = VISIT_KEYS,
    page: str = "website",
    req_time: str = "req_time",
) -> DataFrame:
    """DW-5: for each probe the time of the nearest view of the same page in its slot.

    On equal distance the earlier view wins; without any view the result is NULL.
    The answer depends only on the visit, page and second, so it is worked out once
    per second (at most ``width`` rows per slot and page) and joined back.
    """
    at = [*keys, page, req_time]
    seconds = (
        probes.select(*at, F.lit(False).alias("known"))
        .unionByName(views.select(*at, F.lit(True).alias("known")))
        .groupBy(*at)
        .agg(F.max("known").alias("known"))
        .withColumn("slot", slot_start(req_time, width))
    )
    line = Window.partitionBy(*keys, page, "slot").orderBy(req_time)
    known = F.when(F.col("known"), F.col(req_time))
    here = F.col(req_time)
    earlier = F.last(known, ignorenulls=True).over(
        line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    later = F.first(known, ignorenulls=True).over(
        line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    found = seconds.withColumns({"_earlier": earlier, "_later": later}).select(
        *[F.col(c).alias(f"_{c}") for c in at],
        _closest(here, F.col("_earlier"), F.col("_later")).alias("nearest"),
    )
    # Null-safe, since visits and pages without a name are grouped like any other.
    same = reduce(operator.and_, [probes[c].eqNullSafe(found[f"_{c}"]) for c in at])
    return probes.join(found.filter(F.col("nearest").isNotNull()), same, "left").select(
        *probes.columns, "nearest"
    )


def _closest(here: Column, earlier: Column, later: Column) -> Column:
    return (
        F.when(earlier.isNull(), later)
        .when(later.isNull(), earlier)
        .when(later - here < here - earlier, later)
        .otherwise(earlier)
    )
