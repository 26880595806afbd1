"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a text is a logistic function of a bias, a weight for each feature and, for
each pair of features, the inner product of their factors.  All pairs are summed in
linear time: half of (the square of the sum minus the sum of the squares), by factor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, giving_back, words_of

#: Hashed words, then the bins of structure and metadata, then three for plain numbers.
WORD_DIM, BIN_DIM, BINS = 1 << 16, 1 << 10, 16
DIM = WORD_DIM + BIN_DIM
#: Kinds of bytes whose shares are features: A-Z, a-z, 0-9, white space, sentence marks,
#: other ASCII signs, and what is not ASCII.
KINDS = 7
_KIND = np.full(256, 6, np.int64)
_KIND[:128] = 5
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 0, 1, 2
_KIND[[9, 10, 11, 12, 13, 32]] = 3
_KIND[[33, 39, 44, 46, 58, 59, 63]] = 4


@dataclass
class Machine:
    """Parameters; those of an untrained machine score every text with its bias alone."""

    bias: float = 0.0
    weights: np.ndarray = field(default_factory=lambda: np.zeros(DIM, np.float32))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((DIM, 1), np.float32))


def _bin(value: float, low: float, high: float) -> int:
    return int(min(max((value - low) / (high - low), 0.0), 0.9999) * BINS)


def features(text: str | None, numbers: Sequence[float | None], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids and values of one text; a null text counts as empty.

    Words weigh by their share of the text's length, as a unit vector.  Structure and the
    metadata numbers are put into bins, each bin a feature; null numbers have a bin.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = words_of(text)
    if words:
        ids, counts = np.unique(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)) % np.uint64(WORD_DIM), return_counts=True)
        values = np.sqrt(counts)
        values /= np.sqrt(counts.sum())
    else:
        ids, values = np.empty(0, np.uint64), np.empty(0)
    total = max(len(raw), 1)
    shares = np.bincount(_KIND, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), KINDS) / total
    lines = raw.split(b"\n")
    bins = [_bin(np.sqrt(x), 0, 1) for x in shares]
    bins += [
        _bin(np.log10(1 + len(words)), 0, 5),
        _bin(len(raw) / max(len(words), 1), 0, 20),
        _bin(len(ids) / max(len(words), 1), 0, 1),
        _bin(len(set(lines)) / len(lines), 0, 1),
        _bin(np.log10(1 + len(raw) / len(lines)), 0, 5),
    ]
    bins += [BINS if x is None or not np.isfinite(x) else _bin(np.log10(1 + max(x, 0)), 0, 8) for x in numbers]
    structure = WORD_DIM + (np.arange(len(bins)) * (BINS + 1) + np.array(bins)) % BIN_DIM
    return np.concatenate([ids.astype(np.int64), structure]), np.concatenate([values, np.full(len(bins), 0.3)]).astype(np.float32)


def scores(machine: Machine, ids: np.ndarray, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log odds of the texts whose features stand one after the other."""
    starts = np.cumsum(lengths) - lengths
    linear = np.add.reduceat(machine.weights[ids] * values, starts)
    parts = machine.factors[ids] * values[:, None]
    sums = np.add.reduceat(parts, starts, axis=0)
    squares = np.add.reduceat(parts * parts, starts, axis=0)
    return machine.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], rank: int = 8, epochs: int = 12, rate: float = 0.1, seed: int = 9) -> Machine:
    """Logistic loss, minibatches, one step size for each parameter.

    The classes weigh alike.  Without both of them only the bias is set, to even odds
    when there are no rows at all.
    """
    rng = np.random.default_rng(seed)
    labels = np.array([y for *_, y in rows], np.float64)
    ones = labels.sum()
    if not rows or ones in (0, len(rows)):
        return Machine(bias=float(np.log((ones + 1) / (len(rows) - ones + 1))))
    weigh = np.where(labels == 1, len(rows) / (2 * ones), len(rows) / (2 * (len(rows) - ones)))
    w, v, bias = np.zeros(DIM, np.float32), rng.normal(0, 0.05, (DIM, rank)).astype(np.float32), 0.0
    gw, gv, gb = np.full(DIM, 1e-3), np.full((DIM, rank), 1e-3), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for batch in np.array_split(order, max(1, len(rows) // 128)):
            ids, values = (np.concatenate([rows[i][k] for i in batch]) for k in (0, 1))
            lengths = np.array([len(rows[i][0]) for i in batch])
            odds = scores(Machine(bias, w, v), ids, values, lengths)
            pull = weigh[batch] * (1 / (1 + np.exp(-odds)) - labels[batch]) / len(batch)
            each = np.repeat(pull, lengths)
            parts = v[ids] * values[:, None]
            sums = np.repeat(np.add.reduceat(parts, np.cumsum(lengths) - lengths, axis=0), lengths, axis=0)
            used, place = np.unique(ids, return_inverse=True)
            own = np.bincount(place, each * values, len(used)) + 1e-6 * w[used]
            gw[used] += own**2
            w[used] -= rate * own / np.sqrt(gw[used])
            pairs = (each * values)[:, None] * (sums - parts)
            for f in range(rank):
                step = np.bincount(place, pairs[:, f], len(used)) + 1e-6 * v[used, f]
                gv[used, f] += step**2
                v[used, f] -= rate * step / np.sqrt(gv[used, f])
            gb += pull.sum() ** 2
            bias -= rate * pull.sum() / np.sqrt(gb)
    return Machine(float(bias), w, v)


def held_out(doc_id, folds: int = 3, fold: int = 1):
    """Whether a row is kept from training; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def _read(docs: DataFrame, numbers: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).cast("double").alias(f"number_{i}") for i, c in enumerate(numbers)])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", numbers: Sequence[str] = ("n_chars",), id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 6000) -> Machine:
    """Train on at most ``sample_rows`` labelled rows, the first by a hash of the id.

    Rows held out, with a null id, or whose label is neither 0 nor 1 take no part; of an id
    with two labels the smaller counts.  This bound is the only one: scoring reads all.
    """
    known = (
        labels.where(F.col(label_col).isin(0, 1) & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.min(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows pairs of numbers.
    rows = _read(docs, numbers, id_col, text_col).join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"])

    @giving_back
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for row in batch.to_pylist():
                ids, values = features(row["text"], [row[f"number_{i}"] for i in range(len(numbers))], hashes)
                yield pa.RecordBatch.from_pydict({"doc_id": [row["doc_id"]], "label": pa.array([row["label"]], pa.int32()), "ids": [ids.astype(np.int32).tobytes()], "weights": [values.tobytes()]})

    sample = rows.mapInArrow(extract, "doc_id long, label int, ids binary, weights binary").toArrow().sort_by("doc_id")
    return train([(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["weights"], np.float32), r["label"]) for r in sample.to_pylist()])


def _scorer(machine: Machine, numbers: Sequence[str]):
    """Scores of a batch with the columns ``numbers`` and text, some rows at a time."""
    hashes = WordHashes()

    def run(batch: pa.RecordBatch, text_col: str) -> np.ndarray:
        out = []
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            given = list(zip(*[part.column(c).to_pylist() for c in numbers], strict=True)) if numbers else [()] * part.num_rows
            found = [features(text.as_py(), n, hashes) for text, n in zip(part.column(text_col), given, strict=True)]
            odds = scores(machine, np.concatenate([i for i, _ in found]), np.concatenate([v for _, v in found]), np.array([len(i) for i, _ in found]))
            out.append(1 / (1 + np.exp(-np.clip(odds.astype(np.float64), -500, 500))))
        return np.concatenate(out) if out else np.empty(0)

    return run


def _sent(docs: DataFrame, machine: Machine):
    """A broadcast of the parts of a machine, so that workers need nothing of this package by name."""
    return docs.sparkSession.sparkContext.broadcast((machine.bias, machine.weights, machine.factors))


def quality_scores(docs: DataFrame, machine: Machine, numbers: Sequence[str] = ("n_chars",), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from a score of 0.5) of every row, repeated rows each.

    Null texts score as empty ones; whole texts are read, however long; other columns
    than the id, the text and ``numbers`` are not; an empty table gives no rows.
    """
    model = _sent(docs, machine)
    names = [f"number_{i}" for i in range(len(numbers))]

    @giving_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _scorer(Machine(*model.value), names)
        for batch in batches:
            values = run(batch, "text")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values), pa.array((values >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return _read(docs, numbers, id_col, text_col).mapInArrow(score, "doc_id long, score double, predicted int")


def keep_quality(docs: DataFrame, machine: Machine, numbers: Sequence[str] = ("n_chars",), text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score 0.5 or more."""
    model = _sent(docs, machine)

    @giving_back
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _scorer(Machine(*model.value), numbers)
        for batch in batches:
            yield batch.filter(pa.array(run(batch, text_col) >= 0.5, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
