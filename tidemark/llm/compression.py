"""Quality rules by compression: texts that zstandard packs too well or not well enough.

Prose packs within a band that depends on its length alone: short texts leave a
compressor little to refer back to.  Text that repeats itself packs better than the band
of its length, and random characters, encoded bytes and the like pack worse.  The ratio
of bytes before to bytes after is taken over the whole text and over chunks of a fixed
size, so that a bad stretch is seen in a long text that is good on the whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import giving_back
from tidemark.llm.windows import window_codes, word_codes

#: Length in bytes from which a band holds, least and largest ratio at level 3.  Rules of
#: thumb for prose in any script: Chinese or Japanese in UTF-8 lies at the lower end, text
#: with much markup at the upper one.  Base64 packs to 1.32 at any length; below 64 bytes
#: the frame's own bytes decide, so nothing is too little there.
BANDS = (
    (0, 0.00, 2.20),
    (64, 0.80, 2.20),
    (256, 1.05, 2.20),
    (1024, 1.34, 2.60),
    (4096, 1.36, 2.90),
    (16384, 1.38, 3.30),
    (131072, 1.40, 4.00),
)

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, reason string, n_bytes long, ratio double, n_chunks long, chunks_above long, chunks_below long"
)


@dataclass(frozen=True)
class Limits:
    """``share`` is the part of a text's chunks that may lie outside their bands."""

    bands: tuple[tuple[int, float, float], ...] = BANDS
    chunk_bytes: int = 4096
    share: float = 0.25
    level: int = 3
    least_words: int = 50
    repeat_percent: int = 50


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words inside windows of ``width`` words that the text has more than once, the first included."""
    windows = window_codes(word_codes(words, len(words)), width)
    if not len(windows):
        return 0
    again = np.bincount(windows)[windows] > 1
    inside = np.zeros(len(words), bool)
    for k in range(width):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word in them that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def band_of(n_bytes: int, bands: tuple[tuple[int, float, float], ...]) -> tuple[float, float]:
    """Least and largest ratio of a text of this length."""
    return next((least, most) for start, least, most in reversed(bands) if n_bytes >= start)


def measured(data: bytes, compress, limits: tuple) -> tuple[float | None, int, int, int, str | None]:
    """Ratio of the whole, chunks, those above and below their bands, and the reason to reject, if any."""
    bands, chunk_bytes, share = limits
    if not data:
        return None, 0, 0, 0, None
    ratio = len(data) / len(compress(data))
    least, most = band_of(len(data), bands)
    above = below = 0
    starts = range(0, len(data), chunk_bytes)
    for start in starts:
        size = min(chunk_bytes, len(data) - start)
        one = ratio if size == len(data) else size / len(compress(data[start : start + size]))
        low, high = band_of(size, bands)
        above, below = above + (one > high), below + (one < low)
    if ratio > most:
        reason = "repetitive"
    elif ratio < least:
        reason = "incompressible"
    elif above > share * len(starts):
        reason = "repetitive chunks"
    elif below > share * len(starts):
        reason = "incompressible chunks"
    else:
        reason = None
    return ratio, len(starts), above, below, reason


def quality_rules(docs: DataFrame, limits: Limits | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, compression and verdict of every row; repeated rows each, null ids as they are.

    Words are runs of anything but ASCII white space.  ``n_dup_lines`` counts lines with a
    word that equal an earlier one, ``n_repeat_words`` the words inside three-word windows
    that stand in the text twice or more.  ``base_failed`` is true below ``least_words``
    words or above ``repeat_percent`` of them repeated.  ``kept`` is false for those and
    where ``reason`` names how the text leaves its band: ``repetitive`` or
    ``incompressible`` as a whole, or too many of its chunks.  The last chunk of a text is
    held against the band of its own length; a ratio at a limit is within.

    Null and empty texts have no words, so they fail the base rules; their ratio is null.
    Texts of any length are read whole, in one pass over each.  Only the id and the text
    are read, so extra columns may have any name.  An empty table gives no rows.
    """
    limits = limits or Limits()
    # Plain values travel, so that workers need nothing of this package by name.
    level, least_words, percent = limits.level, limits.least_words, limits.repeat_percent
    bands = tuple(sorted(limits.bands)), limits.chunk_bytes, limits.share

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compress = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False).compress
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                data = text.encode("utf-8", "surrogatepass")
                words = data.split()
                repeated = repeated_words(words)
                failed = len(words) < least_words or 100 * repeated > percent * len(words)
                ratio, chunks, above, below, reason = measured(data, compress, bands)
                word_chars = len(text) - sum(map(text.count, SPACES))
                symbols = sum(map(text.count, SYMBOLS))
                rows.append(
                    (len(words), word_chars, symbols, repeated_lines(text), repeated, failed, not failed and reason is None, reason, len(data), ratio, chunks, above, below)
                )
            if rows:
                types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.float64()] + [pa.int64()] * 3
                columns = [pa.array(values, type_) for values, type_ in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(giving_back(run), SCHEMA)
