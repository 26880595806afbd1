"""Stateful streams.

A shuffle by key sends every row of a busy key to one state task. ``merge_repeats``
drops, before the shuffle, rows that cannot change that key's state, one Arrow batch
at a time, so a busy key arrives in a small number of rows.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidemark.functions.nulls import NOT_SET
from tidemark.functions.times import slot_start
from tidemark.operators.dwell import VISIT_KEYS
from tidemark.streaming.packing import pack_rows, unpacked

# The length of a dwell slot and how long its state is kept, in seconds.
SLOT = 1800
DWELL_TTL = 3600


def merge_repeats(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], ends: bool = False, count: str | None = None) -> DataFrame:
    """Keep the first row of each key per Arrow batch; with ``ends`` also the last.

    Values stay as they are, and NULL is a key like any other. The column ``count``, if
    named, becomes the number of rows that a kept one stands for.
    """
    by, sort = list(keys), [(c, "ascending") for c in ([order] if isinstance(order, str) else order)]
    wanted = [("_at", "min"), ("_at", "max"), ("_at", "count")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch])
                rows = rows.take(pc.sort_indices(rows, sort_keys=sort))
                kept = rows.select(by).append_column("_at", pa.array(range(rows.num_rows))).group_by(by).aggregate(wanted)
                first, last, n = (kept.column(f"_at_{name}").to_numpy() for name in ("min", "max", "count"))
                stands_for = np.zeros(rows.num_rows, np.int64)
                if ends:
                    stands_for[last] = 1
                    n = n - (last != first)
                stands_for[first] = n
                at = np.flatnonzero(stands_for)
                rows = rows.take(pa.array(at))
                if count is not None:
                    rows = rows.set_column(rows.column_names.index(count), count, pa.array(stands_for[at]))
                yield from rows.to_batches()

    return df.mapInArrow(run, df.schema)


def running_counts(df: DataFrame, key: str) -> DataFrame:
    """AG-2: ``(n, key)``; write in update mode to get each change of a count."""
    return df.groupBy(key).agg(F.count("*").alias("n")).select("n", key)


def first_seen_stream(
    df: DataFrame,
    keys: Sequence[str],
    visit: str = "visit_id",
    ts: str = "ts",
    order: str = "event_id",
    keep: str = "2 days",
) -> DataFrame:
    """UV-4 and UV-5: rows whose id is new for their key; exact.

    The row that comes out is of the first micro-batch that holds its id. Of several there,
    one of those that are first, by time and then ``order``, in their Arrow batches.
    The keys hold the date, so state can go once the watermark is two days past.
    """
    columns = [*keys, visit]
    merged = merge_repeats(df, columns, [ts, order])
    return merged.withWatermark(ts, keep).dropDuplicatesWithinWatermark(columns)


class ViewLog:
    """The views of one visit and slot: ``(sign, page) -> [start, end, opened]``.

    ``opened`` numbers the openings, so the latest of two views with the same sign is
    the one opened last.
    """

    def __init__(self, views: dict[tuple[int, str], list[int]]):
        self.views = views
        self.signs: dict[str, list[int]] = {}
        for sign, page in sorted(views):
            self.signs.setdefault(page, []).append(sign)
        self.opened = max((v[2] for v in views.values()), default=0)
        self.latest = max(views, key=lambda k: (k[0], views[k][2]), default=None)

    def add(self, page: str, t: int) -> tuple[str, int, int] | None:
        """Take one event; the increment ``(page, sign, seconds)`` it causes, if any."""
        if self.latest is None:
            self._open(page, t)
            return None
        if t < self.latest[0]:
            sign = self._nearest(page, t)
            if sign is None:
                self._open(page, t)
                return None
            return self._stretch((sign, page), t)
        current = self.latest
        if page != current[1]:
            self._open(page, t)
        return self._stretch(current, t)

    def listed(self) -> list[tuple]:
        """The views, as a text can hold them."""
        return [(*view, *times) for view, times in self.views.items()]

    def _open(self, page: str, t: int) -> None:
        key = (t, page)
        if key not in self.views:
            signs = self.signs.setdefault(page, [])
            signs.insert(bisect_left(signs, t), t)
        self.opened += 1
        self.views[key] = [t, t, self.opened]
        if self.latest is None or t >= self.latest[0]:
            self.latest = key

    def _nearest(self, page: str, t: int) -> int | None:
        signs = self.signs.get(page, [])
        at = bisect_left(signs, t)
        around = signs[max(at - 1, 0) : at + 1]
        return min(around, key=lambda s: (abs(s - t), s), default=None)

    def _stretch(self, key: tuple[int, str], t: int) -> tuple[str, int, int] | None:
        view = self.views[key]
        grown = max(view[0] - t, t - view[1])
        if grown <= 0:
            return None
        view[0], view[1] = min(view[0], t), max(view[1], t)
        return key[1], key[0], grown


_DWELL = (
    "event_id BIGINT, plat INT, agent_type INT, visit_id STRING, slot BIGINT, channel STRING, "
    "website STRING, sign BIGINT, view_time BIGINT"
)
_OUTCOMES = f"{_DWELL}, late BOOLEAN, n BIGINT"
_EVENT_COLUMNS = ["slot", "plat", "agent_type", "visit_id", "req_time", "event_id", "website", "channel", "n"]
#: Slots that share a block of state: two hours; and pages of a block's visits in a bucket.
BLOCK, PAGES = 4 * SLOT, 8


class DwellProcessor(StatefulProcessor):
    """The views of a block of slots and bucket of visits, as a map from a page to its visits and slots.

    A batch reads and writes the pages of the visits that it has events of, as a call to
    the state store costs more than the work on many visits.  A page travels as one text.
    """

    def __init__(self, outcomes: bool):
        self.outcomes = outcomes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page BIGINT", "visits STRING")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() // 1000
        known, pages, block = self.pages.exists(), {}, key[0]
        events = sorted(unpacked(rows, len(key)), key=lambda e: (e[4], e[5] is not None, e[5] or 0))
        for slot, plat, agent_type, visit_id, t, event_id, page, channel, n in events:
            grown, late = None, slot + SLOT + DWELL_TTL <= watermark
            if not late:
                visit = json.dumps((slot, plat, agent_type, visit_id))
                at = crc32(visit.encode()) % PAGES
                if at not in pages:
                    pages[at] = self._stored(at) if known else {}
                log = pages[at].get(visit)
                if not isinstance(log, ViewLog):
                    log = pages[at][visit] = ViewLog({(sign, name): times for sign, name, *times in log or ()})
                grown = log.add(page, t)
            if grown or self.outcomes:
                website, sign, seconds = grown or (page, t, None if late else 0)
                told = dict(event_id=event_id, plat=plat, agent_type=agent_type, visit_id=visit_id, slot=slot)
                told |= dict(channel=channel or NOT_SET, website=website, sign=sign, view_time=seconds)
                yield Row(**told, late=late, n=n) if self.outcomes else Row(**told)
        if pages and not known:
            self.handle.registerTimer((block + BLOCK + DWELL_TTL) * 1000)
        for at, visits in pages.items():
            self.pages.updateValue((at,), (json.dumps(visits, default=ViewLog.listed),))

    def _stored(self, at: int) -> dict[str, list | ViewLog]:
        """The visits of a page; views stay a list until an event of the visit comes."""
        stored = self.pages.getValue((at,))
        return json.loads(stored[0]) if stored else {}

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        self.pages.clear()
        return iter(())

    def close(self) -> None:
        pass


def dwell_stream(df: DataFrame, delay: str = "1 hour", buckets: int | None = None, outcomes: bool = False) -> DataFrame:
    """DW-9: dwell increments of a stream, each emitted as soon as it is known.

    Equals ``dwell_rows`` when a visit's events arrive in time order; a late event
    extends the nearest view of its page, or opens one. Events without a time take no part.

    DW-8, ST-2: a slot takes events until the watermark, ``delay`` behind the latest event,
    is an hour past the slot. With ``outcomes`` every event comes out once: ``late`` is true
    for those behind that, with a NULL ``view_time``; the others have the seconds they
    added, 0 for none. ``sign`` is then the event's own time, as no view holds it, and
    ``n`` counts the events that a row stands for: those of a visit with the same second and page
    are one where they come together. A ``Branch`` on ``late`` stores them apart.

    State is a map of pages of visits of a block of slots and bucket, as calling Python or the
    state store once per visit costs far more than the work itself, and events come packed;
    it goes whole when its slots are past. By
    default there are as many buckets as the session has shuffle partitions; a checkpoint
    belongs to one number of buckets, as it does to one of partitions. Needs the RocksDB
    state store, which declared jobs set.
    """
    if buckets is None:
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visit = [*VISIT_KEYS, "slot"]
    events = df.filter(F.col("req_time").isNotNull()).select(
        *VISIT_KEYS,
        slot_start("req_time", SLOT).alias("slot"),
        F.timestamp_seconds("req_time").alias("ts"),
        "event_id",
        "channel",
        "website",
        "req_time",
        F.lit(1).cast("long").alias("n"),
    )
    merged = merge_repeats(events, [*visit, "req_time", "website"], "event_id", ends=True, count="n")
    timed = (
        merged.withWatermark("ts", delay)
        # Without the time itself Spark leaves rows behind the watermark to the operator.
        .select(
            *_EVENT_COLUMNS,
            (F.col("slot") - F.pmod("slot", F.lit(BLOCK))).alias("block"),
            F.pmod(F.xxhash64(*visit), F.lit(buckets)).alias("bucket"),
        )
    )
    keys = ["block", "bucket"]
    processor = DwellProcessor(outcomes)
    return pack_rows(timed, keys).groupBy(*keys).transformWithState(processor, _OUTCOMES if outcomes else _DWELL, "Append", "EventTime")
