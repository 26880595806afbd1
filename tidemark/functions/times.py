"""Date and time helpers. Local times follow ``spark.sql.session.timeZone``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(c: Column | str) -> Column:
    """F-1: whole epoch seconds, truncated; 0 or NULL means now."""
    c = _col(c)
    return F.when(F.coalesce(c, F.lit(0)) == 0, F.unix_timestamp()).otherwise(c.cast("long"))


def epoch_millis(c: Column | str) -> Column:
    """F-2: epoch milliseconds, half rounded to even; 0 or NULL means now."""
    c = _col(c)
    return F.when(
        F.coalesce(c, F.lit(0)) == 0, F.unix_millis(F.current_timestamp())
    ).otherwise(F.bround(c * 1000).cast("long"))


def day_range(start: Column | str, end: Column | str) -> Column:
    """F-3: array of the days from start to end, both included; empty if reversed."""
    first, last = _col(start).cast("date"), _col(end).cast("date")
    return F.when(
        last >= first, F.sequence(first, last, F.expr("interval 1 day"))
    ).otherwise(F.array().cast("array<date>"))


def hour_labels(day: Column | str) -> Column:
    """F-4: the 24 labels ``yyyy-MM-dd HH`` of a day."""
    # Hours are formatted as text so that clock changes cannot skip or repeat one.
    text = F.date_format(_col(day).cast("date"), "yyyy-MM-dd ")
    return F.transform(
        F.sequence(F.lit(0), F.lit(23)),
        lambda h: F.concat(text, F.lpad(h.cast("string"), 2, "0")),
    )


def date_labels(start: Column | str, end: Column | str, stamps: bool = False) -> Column:
    """F-3..F-5: day labels, or hour labels when both ends are the same day.

    With ``stamps`` the array holds epoch seconds instead of text.
    """
    first, last = _col(start).cast("date"), _col(end).cast("date")
    days = F.transform(day_range(first, last), lambda d: F.date_format(d, "yyyy-MM-dd"))
    labels = F.when(first == last, hour_labels(first)).otherwise(days)
    if not stamps:
        return labels
    return F.transform(
        labels,
        lambda s: F.when(F.length(s) > 10, F.unix_timestamp(F.concat(s, F.lit(":00:00")), "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.unix_timestamp(s, "yyyy-MM-dd")),
    )


def half_month(day: Column | str) -> Column:
    """F-6: struct(start, end) of the half month that holds the day."""
    d = _col(day).cast("date")
    first_half = F.dayofmonth(d) <= 15
    first = F.trunc(d, "month")
    return F.struct(
        F.when(first_half, first).otherwise(F.date_add(first, 15)).alias("start"),
        F.when(first_half, F.date_add(first, 14)).otherwise(F.last_day(d)).alias("end"),
    )


def format_epoch(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """F-7: format epoch seconds; 0 or NULL means now."""
    return F.date_format(F.timestamp_seconds(epoch_seconds(c)), fmt)


def midnight_after(
    c: Column | str, days: int = 1, zone: str = "Asia/Shanghai", raw: bool = False
) -> Column:
    """F-8: epoch seconds of the midnight ``days`` ahead of epoch seconds ``c`` in ``zone``.

    ``raw`` counts days from the UTC date and shifts by eight hours, which is one
    day early for local times before 08:00.
    """
    t = _col(c).cast("long")
    if raw:
        return t - F.pmod(t, F.lit(86400)) + F.lit(86400 * days - 8 * 3600)
    local_day = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _utc_wall_clock(t)))
    midnight = F.date_add(local_day, days).cast("timestamp_ntz")
    return _wall_clock_seconds(F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight))


def slot_start(c: Column | str, width: int = 1800) -> Column:
    """F-12: floor epoch seconds to a multiple of ``width`` seconds of the local clock."""
    t = _col(c).cast("long")
    local = _wall_clock_seconds(F.timestamp_seconds(t).cast("timestamp_ntz"))
    return t - F.pmod(local, F.lit(width))


def text_to_epoch(c: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """F-13: parse local text to epoch seconds; NULL if it does not match."""
    return F.unix_timestamp(F.try_to_timestamp(_col(c), F.lit(fmt)))


def epoch_to_text(c: Column | str) -> Column:
    """F-14: epoch seconds as local ``yyyy-MM-dd HH:mm:ss``."""
    return F.from_unixtime(_col(c), "yyyy-MM-dd HH:mm:ss")


def _wall_clock_seconds(ntz: Column) -> Column:
    return F.timestamp_diff("SECOND", F.expr("timestamp_ntz'1970-01-01 00:00:00'"), ntz)


def _utc_wall_clock(t: Column) -> Column:
    return F.timestamp_add("SECOND", t, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
