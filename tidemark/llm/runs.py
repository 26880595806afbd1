"""Periodic runs of words: stretches that repeat themselves at a fixed distance.

The words of a text are read once, in order.  An active lag q means that the words since
some place equal those q before; each further such word makes its match one longer, and
the first other word ends the diagonal.  A diagonal that ends with a sufficient length is
a run, emitted at once.

Lags begin at earlier occurrences of a word, and the table of active ones stays sparse by
two facts.  A run of period q that is at least four periods and ``LEAST`` words long
matches ``max(3 * q, LEAST - q)`` words in a row, so a lag can begin only where as many
words as the least of its group of lags need occur again.  And only the latest earlier
occurrence of such a window can be the smallest period: if the window, no shorter than q,
also occurs d < q before, the whole stretch has the period gcd(d, q) (Fine and Wilf).  So
each place begins at most one lag of each group, and of the lags in a group, which differ
by a factor of three, a bounded number overlap at a place: the work is near linear in the
length, also for texts that are one word over and over.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import giving_back
from tidemark.llm.windows import window_codes, word_codes

#: A run has at least so many words, and so many periods.
LEAST, PERIODS = 6, 4

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def match_words(lag: int) -> int:
    """Words in a row that a run of this period matches; it grows with the lag."""
    return max(LEAST - lag, (PERIODS - 1) * lag)


def lag_groups(n: int) -> Iterator[tuple[int, int, int]]:
    """Smallest and largest lag of each group for n words, and the words that all its lags match in a row."""
    low = 1
    while max(LEAST, PERIODS * low) <= n:
        width = match_words(low)
        yield low, width, width
        low = width + 1


def lag_starts(words: list[bytes]) -> dict[int, list[int]]:
    """Lags that begin at a place and may become runs."""
    n = len(words)
    starts: dict[int, list[int]] = {}
    first = (words[k:] for k in range(1, LEAST - 1))
    windows = set(zip(words, *first, strict=False))
    if n < LEAST or len(windows) == n - LEAST + 2:
        return starts  # no window of the smallest group occurs twice
    codes = word_codes(words, n)
    for low, high, width in lag_groups(n):
        at = window_codes(codes, width)
        order = np.argsort(at, kind="stable")
        same = at[order[1:]] == at[order[:-1]]
        if not same.any():
            break  # nor does any longer one
        place = order[1:][same]
        lag = place - order[:-1][same]
        chosen = (lag >= low) & (lag <= high)
        place, lag = place[chosen], lag[chosen]
        before = place - lag - 1
        begins = (before < 0) | (codes[place - 1] != codes[before])
        for i, q in zip(place[begins].tolist(), lag[begins].tolist(), strict=True):
            starts.setdefault(i, []).append(q)
    return starts


def word_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    starts = lag_starts(words)
    if not starts:
        return []
    runs: list[tuple[int, int, int]] = []
    active: dict[int, int] = {}  # lag: words matched so far

    def end(lag: int, at: int) -> None:
        length = active.pop(lag) + lag
        if length >= max(LEAST, PERIODS * lag):
            runs.append((at - length, length, lag))

    for i in range(min(starts), len(words)):
        word = words[i]
        for lag in list(active):
            if word == words[i - lag]:
                active[lag] += 1
            else:
                end(lag, i)
        for lag in starts.get(i, ()):
            active[lag] = 1
    for lag in list(active):
        end(lag, len(words))
    return sorted(runs, key=lambda run: (run[0], run[2]))


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: each run keeps its first period."""
    if not runs:
        return words
    change = [0] * (len(words) + 1)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept, inside = [], 0
    for word, more in zip(words, change, strict=False):
        inside += more
        if not inside:
            kept.append(word)
    return kept


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """doc_id, n_words, runs and the collapsed text of every row; repeated rows each.

    Words are runs of anything but ASCII white space, numbered from 0, compared as they
    are.  A run is a stretch with smallest period q that has at least four periods and six
    words and that no neighbouring word extends; runs are sorted by start, then period, and may overlap.
    ``collapsed`` joins by one space the words that stand in no run after its first period.
    ``rewrite`` may change the words of a row before, given its id.

    Null, empty and blank texts have no words, no runs and an empty collapsed text; ids may
    be null or repeated.  Texts are read whole, one at a time, in memory in proportion to the
    longest.  Only the id and the text are read, so extra columns may have any name.
    An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, found, left = [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                if rewrite is not None:
                    words = rewrite(doc_id.as_py(), words)
                runs = word_runs(words)
                counts.append(len(words))
                found.append([{"start": s, "length": length, "period": q} for s, length, q in runs])
                left.append(b" ".join(without_repeats(words, runs)))
            if counts:
                runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, runs_type), pa.array(left, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(giving_back(run), SCHEMA)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a period planted in every tenth text, by its id; texts of null ids as they are."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def best_run(runs: Column) -> Column:
    """The run with the most periods, the earliest and then the shortest period of several; null without any."""

    def better(best: Column, run: Column) -> Column:
        # Cross-multiplied, so that the comparison is exact; runs come by start, then period.
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the best one, and SHA-256 digests of all runs and of the collapsed text."""
    best = found.withColumn("best", best_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
