"""Maximum-entropy scores against counts worked out in plain Python, and held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import maxent_lm


def tokens_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def is_held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 == 1


def plain_scores(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base score) of each (doc_id, text)."""
    counts = Counter(t for i, text in rows if not is_held_out(i) for t in tokens_of(text))
    n, types = sum(counts.values()), len(counts)
    for i, text in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (types + 1))) for t in tokens)
        yield i, is_held_out(i), len(tokens), sum(counts[t] > 0 for t in tokens), n, base


def compare(scored, rows):
    def place(r):
        return (r[0] is None, r[0] or 0, r[2], r[5])

    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in scored), key=place)
    want = sorted(plain_scores(rows), key=place)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored)


def test_documents_and_held_out_gain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    scored = maxent_lm.score(docs, maxent_lm.fit(docs)).collect()
    compare(scored, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    held = [r for r in scored if r.held_out]
    assert held
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


ROWS = [
    (1, "The cat sat on the mat"), (2, "the dog sat on the log"), (2, "the dog sat on the log"), (3, None), (4, ""),
    (5, " \t\n "), (6, "ÉTÉ été Éa\x0bb c"), (7, "word " * 30_000), (None, "the cat"), (None, None), (8, "x" * 100_000),
    *[(i, "a hot text " * 3) for i in range(9, 40)],
]


def test_edges(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like those the operator makes."""
    docs = spark.createDataFrame([(i, t, 1, "x", 2.0) for i, t in ROWS], "doc_id long, text string, row long, word string, count double")
    compare(maxent_lm.score(docs, maxent_lm.fit(docs)).collect(), ROWS)


def test_empty_and_untrained(spark):
    docs = spark.createDataFrame(ROWS[:3], "doc_id long, text string")
    assert maxent_lm.score(docs.limit(0), maxent_lm.fit(docs)).count() == 0
    model = maxent_lm.fit(docs.limit(0))
    scored = maxent_lm.score(docs, model).collect()
    assert {(r.n_known, r.train_tokens) for r in scored} == {(0, 0)}
    assert all(math.isfinite(r.score) for r in scored)


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame(ROWS[:9], "doc_id long, text string")
    model = maxent_lm.fit(docs)
    coder = maxent_lm.Coder()
    codes = coder.encode("the cat sat near an unseen word")
    rows, _ = maxent_lm.contexts(codes, model.classes[maxent_lm.key_of(codes)], np.array([len(codes)]))
    assert np.exp(maxent_lm.log_softmax(model.weights, rows)).sum(1) == pytest.approx(np.ones(len(codes) + 1), abs=1e-5)
    # In a class: its words' smoothed counts and one share for all unseen ones make up the norm.
    by_class = Counter()
    for r in model.counts.select("word", "count").collect():
        code = np.array([r["word"]], np.int64).view(np.uint64)
        by_class[maxent_lm.END if r["word"] == maxent_lm.END_CODE else int(model.classes[maxent_lm.key_of(code)][0])] += r["count"] + 0.5
    norm = model.class_tokens + 0.5 * (model.class_types + 1)
    assert [by_class[c] + 0.5 for c in range(maxent_lm.CLASSES)] == pytest.approx(list(norm))


def plain_log10(model, text):
    """The model's log10 probability of a text, word by word in plain Python."""
    coder, counts = maxent_lm.Coder(), {r["word"]: r["count"] for r in model.counts.select("word", "count").collect()}
    codes = [int(c) for c in coder.encode(text)]
    classes = [int(model.classes[c % maxent_lm.KEYS]) for c in codes] + [maxent_lm.END]
    mask, mix = 2**64 - 1, [int(m) for m in maxent_lm._MIX]
    total = 0.0
    for i, own in enumerate(classes):
        one, two = (codes[i - k] if i >= k else 0 for k in (1, 2))
        before = classes[i - 1] if i else maxent_lm.END
        rows = [
            maxent_lm.ANY,
            (one * mix[0] & mask) >> 48,
            ((two + 1) * mix[1] & mask) >> 48,
            (((one * mix[2] & mask) ^ (two * mix[3] & mask)) * mix[0] & mask) >> 48,
            (before + 7) * 31,
        ]
        logits = [sum(float(model.weights[r][c]) for r in rows) for c in range(maxent_lm.CLASSES)]
        of_class = math.exp(logits[own]) / sum(map(math.exp, logits))
        word = maxent_lm.END_CODE if i == len(codes) else int(np.array([codes[i]], np.uint64).view(np.int64)[0])
        share = (counts.get(word, 0) + 0.5) / (model.class_tokens[own] + 0.5 * (model.class_types[own] + 1))
        total += math.log10(of_class * share)
    return total


def test_scores_are_those_of_the_model(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = maxent_lm.fit(docs)
    few = docs.where("doc_id % 10 = 3").unionByName(spark.createDataFrame([(-1, "zzzq unseen words"), (-2, None), (-3, "a")], "doc_id long, text string"), allowMissingColumns=True)
    for r in (scored := {r.doc_id: r for r in maxent_lm.score(few, model).collect()}).values():
        text = next(d.text for d in few.where(F.col("doc_id") == r.doc_id).collect())
        assert r.score == pytest.approx(plain_log10(model, text), rel=1e-4)
    assert len(scored) == few.count()


def test_words_of_batches_are_those_of_texts():
    import pyarrow as pa

    coder = maxent_lm.Coder()
    texts = [text for _, text in ROWS] + [" a\x0bb\x1cc\x85d e\u3000f\x0c", "\r\n", "ÀA ßZ\tİ"]
    codes, lengths = coder.encode_all(pa.array(texts, pa.string()))
    assert np.array_equal(codes, np.concatenate([coder.encode(t) for t in texts])) and lengths.tolist() == [len(coder.encode(t)) for t in texts]


def test_changes_are_averaged_by_row(spark):
    """A row that one task met moves as that task says; levels give what one group would."""
    rng = np.random.default_rng(5)
    rows, total, times = [], np.zeros((maxent_lm.ROWS // maxent_lm.BLOCKS, 2, maxent_lm.CLASSES)), np.zeros(maxent_lm.ROWS // maxent_lm.BLOCKS)
    for task in range(0, 3000, 37):
        used = np.sort(rng.choice(50, 20, replace=False)) if task else np.array([900])
        met, change = rng.integers(1, 9, len(used)).astype(np.float32), rng.normal(size=(len(used), 2, maxent_lm.CLASSES)).astype(np.float16)
        rows.append((3, task, used.astype(np.uint16).tobytes(), met.tobytes(), change.tobytes()))
        total[used] += met[:, None, None] * change
        times[used] += met
    (got,) = maxent_lm._together(spark.createDataFrame(rows, maxent_lm.CHANGE).repartition(5)).collect()
    used = np.frombuffer(got["used"], np.uint16)
    assert got["block"] == 3 and used.tolist() == np.flatnonzero(times).tolist()
    assert np.frombuffer(got["met"], np.float32) == pytest.approx(times[used])
    assert np.frombuffer(got["change"], np.float16).reshape(-1, 2, maxent_lm.CLASSES) == pytest.approx(total[used] / times[used, None, None], abs=5e-3)


def test_null_id_is_held_out(spark):
    frame = spark.createDataFrame([(None,), (0,)], "doc_id long").select("doc_id", maxent_lm.held_out(F.col("doc_id")).alias("h"))
    assert {(r.doc_id, r.h) for r in frame.collect()} == {(None, True), (0, is_held_out(0))}


def test_texts_are_encoded_some_at_a_time():
    """What a worker holds while it encodes a batch does not grow with the batch."""
    texts = [f"w{i} " * 20_000 + f"end{i}" for i in range(160)]  # 12 MB in one batch
    columns = [pa.array(range(160)), pa.array(range(160)), pa.array([False] * 160), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "held_out", "text"])
    parts = list(maxent_lm._encoded(iter([batch])))
    largest = max(len(t) for t in texts)
    at = 0
    for part in parts:
        assert sum(map(len, texts[at : at + part.num_rows])) < (1 << 21) + largest
        at += part.num_rows
    assert at == 160 and [i for part in parts for i in part.column("row").to_pylist()] == list(range(160))
    coder = maxent_lm.Coder()
    assert coder.limit <= 1 << 18
    for i in (0, 77, 159):
        (codes,) = [c.as_py() for part in parts for r, c in zip(part.column("row").to_pylist(), part.column("codes")) if r == i]
        assert codes == coder.encode(texts[i]).tobytes()
