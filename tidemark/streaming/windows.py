"""User code over the values of a key in an event-time window.

The rows of an open window are keyed state.  When the watermark has passed the window
they are handed to the caller's function, with the key and the window, as an iterator
over lists of bounded size, so a hot window is never whole in memory.  Tumbling windows
of a hot key can be dealt into parts besides, each a state and a call of its own.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemark.streaming.packing import pack_rows, unpacked

#: Gets the key, the window (start and end, in epoch seconds) and its values, some rows at a
#: time; gives the columns of the result, one tuple for each row.
WindowFunction = Callable[[tuple, tuple[int, int], Iterator[list[Row]]], Iterable[tuple]]

#: Rows of a window that are handed over together, and that are one value of the state.
PART_ROWS, STATE_ROWS = 10_000, 500
#: Groups of keys that share the state of their sessions, and rows of one that are put in order together.
BUCKETS, ORDERED_ROWS = 1024, 1 << 15


def in_parts(rows: Iterable, size: int) -> Iterator[list]:
    """Rows, a list of at most ``size`` at a time."""
    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        yield part


class _Windows(StatefulProcessor):
    """What tumbling and session windows share: calling the function and naming its results."""

    def __init__(self, keys: Sequence[str], values: StructType, function: WindowFunction, result: Sequence[str], part_rows: int):
        self.keys, self.values, self.function, self.result, self.part_rows = list(keys), values, function, list(result), part_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def chunk_type(self) -> StructType:
        return StructType([StructField("rows", ArrayType(self.values))])

    def call(self, key: tuple, window: tuple[int, int], values: Iterable[tuple]) -> Iterator[Row]:
        told = dict(zip(self.keys, key, strict=True)) | {"window_start": window[0], "window_end": window[1]}
        make = Row(*self.values.names)
        parts = ([make(*row) for row in part] for part in in_parts(values, self.part_rows))
        for out in self.function(key, window, parts):
            yield Row(**told, **dict(zip(self.result, out, strict=True)))

    def close(self) -> None:
        pass


class TumblingWindows(_Windows):
    """State of one window of a key, or of one part of it."""

    def __init__(self, size: int, *rest):
        super().__init__(*rest)
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rows = handle.getMapState("chunks", "number BIGINT", self.chunk_type())
        self.chunks = handle.getValueState("n_chunks", "n BIGINT")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        end = key[-2] + self.size
        # Rows of a window that is gone are late.
        if end * 1000 > timerValues.getCurrentWatermarkInMs():
            known = self.chunks.get()
            if known is None:
                self.handle.registerTimer(end * 1000)
            number = known[0] if known else 0
            for chunk in in_parts(unpacked(rows, len(key)), STATE_ROWS):
                self.rows.updateValue((number,), (chunk,))
                number += 1
            self.chunks.update((number,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        *own, start, _ = key
        chunks = (self.rows.getValue((number,))[0] for number in range(self.chunks.get()[0]))
        yield from self.call(tuple(own), (start, start + self.size), map(tuple, itertools.chain.from_iterable(chunks)))
        self.rows.clear()
        self.chunks.clear()


class SessionWindows(_Windows):
    """State of a bucket of keys: their open sessions, and the rows of these in numbered chunks.

    Rows that arrive together make sessions, which are joined to the stored ones that they
    touch: a session is the chunks that it took over, so joining moves no row.  The timer is
    that of the session that ends first.
    """

    def __init__(self, gap: int, key_type: StructType, *rest):
        super().__init__(*rest)
        self.gap, self.key_type = gap, key_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        session = StructType().add("who", "string").add("key", self.key_type).add("start", "long").add("last", "long").add("chunks", ArrayType(LongType()))
        self.sessions = handle.getValueState("sessions", StructType().add("next", "long").add("open", ArrayType(session)))
        self.rows = handle.getMapState("chunks", "number BIGINT", self.chunk_type())

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        number, stored = self.sessions.get() or (0, [])
        open_: dict[str, dict[int, tuple]] = {}
        for who, own, start, last, chunks in stored:
            open_.setdefault(who, {})[start] = (tuple(own), last, list(chunks))
        n_keys = len(self.keys)
        for arrived in in_parts(unpacked(rows, len(key)), ORDERED_ROWS):
            for session in self._cut(sorted(arrived, key=lambda e: e[:2])):
                (who, start), last = session[0][:2], session[-1][1]
                others = open_.setdefault(who, {})
                touched = sorted(s for s, (_, e, _) in others.items() if s <= last + self.gap and e >= start - self.gap)
                if not touched and (last + self.gap) * 1000 <= watermark:
                    continue  # late: no session is left that it belongs to
                taken = [others.pop(s) for s in touched]
                chunks = [chunk for *_, chunks in taken for chunk in chunks]
                for chunk in in_parts((event[2 + n_keys :] for event in session), STATE_ROWS):
                    self.rows.updateValue((number,), (chunk,))
                    chunks.append(number)
                    number += 1
                start, last = min([start, *touched]), max([last, *(e for _, e, _ in taken)])
                others[start] = session[0][2 : 2 + n_keys], last, chunks
        self._store(number, [(who, own, start, last, chunks) for who, own_ in open_.items() for start, (own, last, chunks) in own_.items()])
        return iter(())

    def _store(self, number: int, sessions: list[tuple]) -> None:
        """Keep the open sessions, and a timer for the first end; an earlier one that is left finds nothing to do."""
        if sessions:
            self.sessions.update((number, sessions))
            self.handle.registerTimer((min(session[3] for session in sessions) + self.gap) * 1000)
        else:
            self.sessions.clear()

    def _cut(self, events: list[tuple]) -> Iterator[list[tuple]]:
        """Events in order of their key and time, cut where a gap is."""
        session: list[tuple] = []
        for event in events:
            if session and (event[0] != session[-1][0] or event[1] > session[-1][1] + self.gap):
                yield session
                session = []
            session.append(event)
        if session:
            yield session

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        number, stored = self.sessions.get() or (0, [])
        left = []
        for who, own, start, last, chunks in stored:
            if (last + self.gap) * 1000 <= watermark:
                yield from self.call(tuple(own), (start, last + self.gap), self._taken(chunks))
            else:
                left.append((who, tuple(own), start, last, list(chunks)))
        if len(left) < len(stored):
            self._store(number, left)

    def _taken(self, chunks: Sequence[int]) -> Iterator[tuple]:
        """The rows of a session's chunks, each removed once it is read."""
        for number in chunks:
            (chunk,) = self.rows.getValue((number,))
            self.rows.removeKey((number,))
            yield from map(tuple, chunk)


def _result(df: DataFrame, keys: Sequence[str], schema: str) -> tuple[str, list[str]]:
    own = StructType.fromDDL(schema)
    named = ", ".join(f"`{key}` {df.schema[key].dataType.simpleString()}" for key in keys)
    return f"{named}, window_start BIGINT, window_end BIGINT, {schema}", own.names


def apply_tumbling(
    df: DataFrame, keys: Sequence[str], ts: str, size: int, function: WindowFunction, schema: str,
    delay: str = "10 minutes", parts: int = 1, part_rows: int = PART_ROWS,
) -> DataFrame:
    """Call ``function`` for every key and window of ``size`` seconds, once the watermark has passed it.

    Returns the keys, window_start, window_end and the columns of ``schema``, the function's
    results.  With ``parts`` the rows of a window are dealt into so many states by a hash
    of them, and the function is called for each: its results are then to be combined by
    key and window, as partial aggregates are.  Rows without a time take no part, nor do
    rows of windows that the watermark has passed; NULL keys are keys.
    """
    given = StructType([f for f in df.schema.fields if f.name not in keys])
    whole, names = _result(df, keys, schema)
    at = F.unix_timestamp(ts)
    rows = df.filter(F.col(ts).isNotNull()).withColumns({
        "_start": at - F.pmod(at, F.lit(size)),
        "_part": F.pmod(F.xxhash64(*df.columns), F.lit(parts)).cast("int"),
        "_at": F.col(ts),
    })
    # Without the time itself Spark leaves rows behind the watermark to the operator.
    own = [*keys, "_start", "_part"]
    rows = rows.withWatermark("_at", delay).select(*own, *given.names)
    processor = TumblingWindows(size, keys, given, function, names, part_rows)
    return pack_rows(rows, own).groupBy(*own).transformWithState(processor, whole, "Append", "EventTime")


def apply_sessions(
    df: DataFrame, keys: Sequence[str], ts: str, gap: int, function: WindowFunction, schema: str,
    delay: str = "10 minutes", part_rows: int = PART_ROWS, buckets: int = BUCKETS,
) -> DataFrame:
    """Call ``function`` for every session of a key: rows with no more than ``gap`` seconds between them.

    A session ends when the watermark is ``gap`` past its last row; ``window_end`` is that
    time.  Its values come as they arrived, those that came together by time.  Rows that
    touch no open session and would make one that has ended are late and left out.  Keys are
    dealt into ``buckets`` that share a state, as calling Python and the state store once per
    key costs more than the work itself; a checkpoint belongs to one number of them.
    """
    given = StructType([f for f in df.schema.fields if f.name not in keys])
    whole, names = _result(df, keys, schema)
    # A text of the key tells keys apart, as their values may come back from the state in another form.
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    rows = df.filter(F.col(ts).isNotNull()).withColumns({
        "_bucket": F.pmod(F.xxhash64(*keys), F.lit(buckets)),
        "_who": F.to_json(F.struct(*keys), exact),
        "_t": F.unix_timestamp(ts),
        "_at": F.col(ts),
    })
    rows = rows.withWatermark("_at", delay).select("_bucket", "_who", "_t", *keys, *given.names)
    key_type = StructType([df.schema[key] for key in keys])
    processor = SessionWindows(gap, key_type, keys, given, function, names, part_rows)
    return pack_rows(rows, ["_bucket"]).groupBy("_bucket").transformWithState(processor, whole, "Append", "EventTime")
