"""Compression bands, whitening and periodic runs, against plain versions of them."""

import base64
import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import zstandard

from tidemark.llm import compression, runs, whitening
from tidemark.llm.windows import window_codes, word_codes

DOCS = "doc_id long, text string, ratio string, runs long, words string"


def docs_of(spark, texts):
    """Documents with extra columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts], DOCS)


def test_windows_are_numbered_exactly():
    rng = random.Random(1)
    words = [rng.choice([b"a", b"b"]) for _ in range(300)]
    codes = word_codes(words, len(words))
    for width in (1, 2, 3, 5, 18, 57, 300, 301):
        want = [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]
        got = window_codes(codes, width).tolist()
        assert len(got) == len(want) and len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


# --- compression bands ----------------------------------------------------------------------


def plain_counts(text):
    """Words, their characters, symbols, repeated lines and words of repeated windows, one by one."""
    words, word = [], ""
    for c in (text or "") + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    seen, lines = [], 0
    for line in (text or "").split("\n"):
        if any(c not in " \t\n\x0b\x0c\r" for c in line):
            lines += line in seen
            seen.append(line)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {t for t, n in Counter(triples).items() if n > 1}
    inside = {i + k for i, t in enumerate(triples) if t in twice for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), lines, len(inside)


def prose(n, seed=0):
    """Words of a vocabulary in which some are much more frequent."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(4000)]
    return " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(4000)], k=n))


def test_counts_of_the_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in compression.quality_rules(docs).collect()}
    pack = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)
    for d in docs.collect():
        r, want = got.pop(d.doc_id), plain_counts(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and r.reason is None)
        data = d.text.encode()
        assert r.n_bytes == len(data) and r.n_chunks == -(-len(data) // 4096)
        assert r.ratio == len(data) / len(pack.compress(data))
    assert not got


def test_bands_reject_what_repeats_and_what_is_random(spark):
    rng = random.Random(3)
    good = [prose(n, seed=n) for n in (60, 200, 900, 5000, 60000)]
    encoded = base64.b64encode(rng.randbytes(9000)).decode()
    # Every word is another one, so that no window repeats.
    counted = " ".join(f"record{i:07d}" for i in range(2000))
    blocks = "\n".join(encoded[i : i + 76] for i in range(0, len(encoded), 76))
    half = prose(1600, seed=8) + "\n" + blocks
    texts = list(enumerate([*good, blocks, counted, half, good[0], None]))
    got = {r.doc_id: r for r in compression.quality_rules(docs_of(spark, texts)).collect()}
    assert all(got[i].kept for i in range(len(good))) and got[8].kept
    n = len(good)
    assert [(got[i].kept, got[i].base_failed, got[i].reason) for i in (n, n + 1, n + 2)] == [
        (False, False, "incompressible"),
        (False, False, "repetitive"),
        (False, False, "incompressible chunks"),
    ]
    loose = compression.Limits(bands=((0, 0.0, 1e9),))
    assert all(r.kept for r in compression.quality_rules(docs_of(spark, texts[:8]), loose).collect())


def test_compression_edges(spark):
    line = prose(60, seed=4)
    texts = [(1, None), (2, ""), (3, " \t\n "), (4, "a\r\na\r\na"), (None, line), (5, line), (5, line), (6, "é " * 400_000), (7, "a b c a b c")]
    got = compression.quality_rules(docs_of(spark, texts)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in texts)
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].n_words, by_id[i].ratio, by_id[i].kept, by_id[i].base_failed) for i in (1, 2)] == [(0, None, False, True)] * 2
    assert (by_id[3].n_words, by_id[3].n_dup_lines) == (0, 0)
    assert (by_id[4].word_chars, by_id[4].n_dup_lines, by_id[4].n_repeat_words) == (3, 1, 0)
    assert by_id[None].kept and by_id[5].kept
    assert (by_id[6].n_words, by_id[6].word_chars, by_id[6].n_repeat_words, by_id[6].kept) == (400_000, 400_000, 400_000, False)
    assert by_id[7].n_repeat_words == 6
    assert compression.quality_rules(docs_of(spark, [])).count() == 0


# --- whitening --------------------------------------------------------------------------------


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, x string, n int")


def exact_scatter(x):
    n, d = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(d)]
    return whitening.Scatter(n, tuple(sums), tuple(tuple(n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(d)) for i in range(d)))


def leverrier(matrix):
    """The characteristic polynomial by traces of powers, in fractions."""
    d = len(matrix)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = [[sum(matrix[i][t] * m[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(am[i][i] for i in range(d)) / k)
    return [int(v) for v in reversed(c)]


@pytest.mark.parametrize("d,n,seed", [(1, 5, 0), (2, 9, 1), (5, 30, 2), (8, 4, 3), (9, 200, 4)])
def test_polynomial_is_exact(spark, d, n, seed):
    rng = random.Random(seed)
    scatter = exact_scatter([[rng.randint(-500, 500) for _ in range(d)] for _ in range(n)])
    assert whitening.characteristic_polynomial(spark, scatter) == leverrier(scatter.matrix)


def test_polynomial_where_columns_vanish(spark):
    """Zero subdiagonals on the way, and pivots that have to be exchanged."""
    for matrix in ([[0, 0, 3], [0, 5, 0], [3, 0, 0]], [[7, 0, 0, 0], [0, 7, 0, 0], [0, 0, 0, 0], [0, 0, 0, 2]]):
        for p in (101, 65537, whitening.LARGEST_PRIME):
            got = whitening.polynomial_mod(np.array(matrix, np.int64), p).tolist()
            assert got == [c % p for c in leverrier(matrix)]


def test_roots_are_counted_and_refined():
    # (t - 9)^2 (t - 9 + 1/1024 as 9215/1024) (t - 4) t, times 1024
    polynomial = [1]
    for factor in ([-9, 1], [-9, 1], [-9215, 1024], [-4, 1], [0, 1]):
        polynomial = [sum(polynomial[i] * factor[j] for i in range(len(polynomial)) for j in range(2) if i + j == k) for k in range(len(polynomial) + 1)]
    above = [whitening.roots_above(polynomial, m, 1) for m in (-1, 0, 7, 8, 17, 18)]
    assert above == [5, 4, 4, 3, 3, 0]
    # Of an even number of roots in an interval the sign says nothing, so they are told apart by counts.
    got = [Fraction(*r) for r in whitening.largest_roots(polynomial, 4, 80)]
    assert got == [9, 9, Fraction(9215, 1024), 4]
    larger, smaller = (Fraction(*r) - 2 for r in whitening.largest_roots([2, -4, 1], 2, 100))
    assert larger > 0 > smaller and max(abs(larger**2 - 2), abs(smaller**2 - 2)) < Fraction(1, 1 << 90)


def test_embeddings_against_double_precision(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = whitening.whitened(emb).collect()
    table = emb.toPandas()
    x = np.floor(256 * np.array(table.embedding.tolist(), float))
    u = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True))
    want = (x - u.mean(0)) @ vectors[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    at = {v: i for i, v in enumerate(table.vec_id)}
    got = np.zeros_like(want)
    for r in rows:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(u) and abs(r.explained - values[::-1][r.component - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9
        assert r.deviation == sum((len(u) * int(a) - int(s)) ** 2 for a, s in zip(x[at[r.vec_id]], u.sum(0), strict=True)) == int(r.deviation_exact)
    assert len(rows) == 4 * len(x)
    signs = np.sign((got * want).sum(0))
    assert np.abs(got - want * signs).max() < 1e-9


def test_whitening_of_skewed_and_repeated_rows(spark):
    """A vector with a third of all rows counts once; rows keep their own results."""
    rng = random.Random(5)
    others = [[rng.gauss(0, 1 + j) for j in range(6)] for _ in range(80)]
    rows = [(i, v) for i, v in enumerate(others)] + [(1000 + i, others[0]) for i in range(60)] + [(7, others[7]), (None, others[9])]
    bad = [(2000, None), (2001, [1.0] * 5 + [float("nan")]), (2002, [None] * 6), (2003, [float("inf")] * 6), (2004, []), (2005, [1.0, 2.0])]
    got = whitening.whitened(vectors_of(spark, rows + bad).repartition(7)).collect()
    assert Counter(r.vec_id for r in got) == Counter([i for i, _ in rows] * 4)
    assert {r.n for r in got} == {len({tuple(np.floor(256 * np.array(v))) for v in others})}
    assert len({(r.component, r.whitened) for r in got if r.vec_id in (0, *range(1000, 1060))}) == 4
    alone = whitening.whitened(vectors_of(spark, list(enumerate(others)))).collect()
    one = {(r.vec_id, r.component): r.whitened for r in alone}
    assert all(abs(abs(one[r.vec_id, r.component]) - abs(r.whitened)) < 1e-9 for r in got if r.vec_id is not None and r.vec_id < 80)


def test_whitening_edges(spark):
    assert whitening.whitened(vectors_of(spark, [])).count() == 0
    assert whitening.whitened(vectors_of(spark, [(1, None)])).count() == 0
    assert whitening.whitened(vectors_of(spark, [(i, [0.5, -0.0]) for i in range(3)])).count() == 0
    # Two vectors have one component; of equal eigenvalues any two at right angles will do.
    two = whitening.whitened(vectors_of(spark, [(1, [0.0, 0.0, 1.0]), (2, [1.0, 0.0, 1.0])])).collect()
    assert sorted((r.vec_id, r.component, round(abs(r.whitened), 12), r.explained, r.deviation) for r in two) == [(1, 1, 1.0, 1.0, 65536), (2, 1, 1.0, 1.0, 65536)]
    corners = [(i, [float(i & 1), float(i >> 1 & 1), float(i >> 2 & 1)]) for i in range(8)]
    cube = whitening.whitened(vectors_of(spark, corners)).collect()
    assert len(cube) == 24 and {round(r.explained, 12) for r in cube} == {round(1 / 3, 12)}
    assert max(r.identity_error for r in cube) < 1e-12
    assert all(abs(sum(r.whitened**2 for r in cube if r.vec_id == i) - 3) < 1e-9 for i in range(8))
    # Entries beyond what doubles and longs add exactly.
    large = [(i, [1e15 * (i + 1), 3e13 * i * i, 1.0]) for i in range(5)]
    got = whitening.whitened(vectors_of(spark, large)).collect()
    x = [[int(np.floor(256 * c)) for c in v] for _, v in large]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for r in got:
        exact = sum((5 * a - s) ** 2 for a, s in zip(x[r.vec_id], sums, strict=True))
        assert r.deviation_exact == str(exact) and r.deviation == (exact if exact < 1 << 63 else None)
    assert len(got) == 10 and max(r.identity_error for r in got) < 1e-6
    beyond = whitening.whitened(vectors_of(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [5.0, 9.0])])).collect()
    assert len(beyond) == 6 and max(r.identity_error for r in beyond) < 1e-6


# --- periodic runs ------------------------------------------------------------------------------


def plain_runs(words):
    """Every stretch of every period, from the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            start = i
            while i < n and words[i] == words[i - q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(6, 4 * q):
                found.setdefault((start - q, length), q)
            i += 1
    return sorted((s, length, q) for (s, length), q in found.items())


def test_runs_of_random_and_built_words():
    rng = random.Random(13)
    hits = 0
    for n in range(1500):
        letters = rng.choice(["a", "ab", "ab", "abc", "abcdefgh"])
        words = rng.choices(letters.encode(), k=rng.randint(0, 60))
        words = [bytes([w]) for w in words]
        if n % 3:  # repeat pieces, which may hold repeats themselves
            for _ in range(rng.randint(1, 3)):
                piece = words[: rng.randint(1, 8)] or [b"a"]
                at = rng.randint(0, len(words))
                words = words[:at] + piece * rng.randint(2, 9) + words[at:]
        got = runs.word_runs(words)
        assert [(s, length, q) for s, length, q in got] == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        hits += len(got)
    assert hits > 1000


def test_long_repetitive_texts_take_linear_work():
    for words in ([b"a"] * 200_000, [b"a", b"a", b"b"] * 60_000, ([b"a", b"b"] * 40 + [b"x"]) * 2000, [b"a"] * 50_000 + [b"b"] + [b"a"] * 50_000):
        starts = runs.lag_starts(words)
        assert sum(map(len, starts.values())) < len(words) / 10
        for start, length, period in (found := runs.word_runs(words)):
            assert all(words[i] == words[i - period] for i in range(start + period, start + length, 997))
        assert found
    fibonacci = [b"a"], [b"a", b"b"]
    for _ in range(14):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert runs.word_runs(fibonacci[1]) == sorted(plain_runs(fibonacci[1]), key=lambda r: (r[0], r[2]))
    thue = [bytes([97 + bin(i).count("1") % 2]) for i in range(4096)]
    assert runs.word_runs(thue) == []


def test_digests_of_the_documents(spark, sf):
    """The whole query against plain code; some texts have a planted period."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    kept = docs.collect()
    got = {r.doc_id: r for r in runs.digests(runs.periodic_runs(docs, rewrite=runs.planted)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for d in kept:
        words = d.text.split()
        h = zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and words:
            g = h // 10
            a = g % len(words)
            p = 1 + (len(words) - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        r = got.pop(d.doc_id)
        assert r.n_runs == len(found)
        assert r.runs_sha256 == digest("".join(f"{s},{length},{q}\n" for s, length, q in found))
        assert r.collapsed_sha256 == digest(" ".join(w for i, w in enumerate(words) if i not in gone))
        best = min(found, key=lambda x: (Fraction(-x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
    assert not got


def test_run_edges(spark):
    texts = [(1, None), (2, ""), (3, " \n"), (4, "a a a a a"), (5, "a a a a a a"), (None, "A a A a A a A a A"), (5, "a a a a a a"), (6, "x " + "é ß " * 150_000), (7, "b b b b b b c c c c c c c")]
    got = runs.periodic_runs(docs_of(spark, texts)).collect()
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == [
        ("1", 0, [], ""),
        ("2", 0, [], ""),
        ("3", 0, [], ""),
        ("4", 5, [], "a a a a a"),
        ("5", 6, [(0, 6, 1)], "a"),
        ("5", 6, [(0, 6, 1)], "a"),
        ("6", 300_001, [(1, 300_000, 2)], "x é ß"),
        ("7", 13, [(0, 6, 1), (6, 7, 1)], "b c"),
        ("None", 9, [(0, 9, 2)], "A a"),
    ]
    digest = runs.digests(runs.periodic_runs(docs_of(spark, texts[-1:]))).head()
    assert (digest.n_runs, digest.start, digest.length, digest.period, digest.exponent_milli) == (2, 6, 7, 1, 7000)
    none = runs.digests(runs.periodic_runs(docs_of(spark, texts[:1]))).head()
    assert (none.n_runs, none.start, none.exponent_milli, none.runs_sha256) == (0, None, None, hashlib.sha256(b"").hexdigest())
    assert runs.digests(runs.periodic_runs(docs_of(spark, []))).count() == 0
