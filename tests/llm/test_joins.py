"""The Jaccard join, its components, and neighbour search, against brute force."""

import itertools
import tracemalloc
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import jaccard_join, neighbours
from tidemark.llm.graph import components

DOCS = "doc_id long, text string, n long, component_id long, k1 string"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in texts], DOCS)


def groups(edges, nodes):
    """Smallest node reachable from each."""
    name = {v: v for v in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(name[a], name[b])
            changed |= name[a] != low or name[b] != low
            name[a] = name[b] = low
    return name


def brute(texts):
    sets = {}
    for d, text in texts:
        w = (text or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    names = groups(links, sets)
    return {d: (len(sets[d]), names[d]) for d in sets}


def found(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicate_groups(docs).collect()}


def edited(text, rng, most):
    w = text.split()
    for _ in range(rng.randint(0, most)):
        p = rng.randrange(len(w))
        w[p : p + 1] = rng.choice([[], ["new%d" % rng.randrange(10**6)], [w[p], "more"]])
    return " ".join(w)


def family(seed, n, length, edits):
    rng = random.Random(seed)
    base = " ".join("w%d" % rng.randrange(2000) for _ in range(length))
    return [edited(base, rng, edits) for _ in range(n)]


@pytest.mark.parametrize(("n", "length", "edits"), [(60, 40, 4), (60, 120, 8), (40, 300, 14), (80, 9, 2), (30, 900, 40)])
def test_groups_of_edited_copies(spark, n, length, edits):
    """Groups larger than RARE, at and around the threshold: chains, pairs and lone ones."""
    texts = list(enumerate(family(length, n, length, edits) + family(length + 1, 5, length, edits)))
    random.Random(1).shuffle(texts)
    assert found(docs_of(spark, texts)) == brute(texts)


def test_shared_passage_links_nothing(spark):
    rng = random.Random(5)
    passage = " ".join("p%d" % i for i in range(60))
    texts = [(i, passage + " " + " ".join("u%d" % rng.randrange(10**9) for _ in range(rng.randint(20, 60)))) for i in range(60)]
    assert found(docs_of(spark, texts)) == brute(texts)


def test_two_passages_meet_in_every_mix(spark):
    """Texts made of whole shared passages have few tokens of their own, and mostly no links."""
    parts = [" ".join(f"p{k}x{i}" for i in range(30)) for k in range(6)]
    texts = [(i, " ".join(c)) for i, c in enumerate(itertools.permutations(parts, 3))]
    assert found(docs_of(spark, texts)) == brute(texts)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_join_edges(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    texts = [(7, None), (8, ""), (9, " \t\n"), (1, "one two"), (2, "ONE  two"), (3, "two one"), (4, a), (5, b), (6, a), (6, a), (11, "x " * 70000)]
    frame = docs_of(spark, texts)
    rows = jaccard_join.near_duplicate_groups(frame).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted((d, *brute(texts)[d]) for d, _ in texts)
    nulls = jaccard_join.near_duplicate_groups(docs_of(spark, [(None, a), (4, a)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in nulls) == [("4", "4"), ("None", "None")]
    # Rows of one id are one document: it holds both groups together.
    both = jaccard_join.near_duplicate_groups(docs_of(spark, [(3, a), (4, a), (4, b), (5, b)])).collect()
    assert {(r.doc_id, r.component_id) for r in both} == {(3, 3), (4, 3), (5, 3)}
    assert jaccard_join.near_duplicate_groups(frame.limit(0)).count() == 0


def test_texts_of_one_id_are_compared_each(spark):
    """Near, not exact, copies of either text of an id link with it, in any order of rows."""
    a, b, c = (" ".join(f"{k}{i}" for i in range(60)) for k in "abc")
    near = lambda text: text + " end"
    rows = [(4, a), (4, b), (8, near(a)), (9, near(b)), (4, c), (1, near(c)), (20, "z " + near(b)), (30, "q r s t u v w")]
    for texts in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = {(r.doc_id, r.component_id) for r in jaccard_join.near_duplicate_groups(docs_of(spark, texts)).collect()}
        assert got == {(4, 1), (8, 1), (9, 1), (1, 1), (20, 1), (30, 30)}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {v for e in edges if e[0] != e[1] for v in e}
    assert got == {v: g for v, g in groups(edges, {v for e in edges for v in e}).items() if v in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlaps_of_blocks():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 90))) for _ in range(150)]
    got = jaccard_join._overlaps(sets[:80], sets[80:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[80:]] for a in sets[:80]]


# --- neighbours -------------------------------------------------------------------------


def exact(rows, queries, k):
    out = {}
    for q, x in queries:
        near = sorted((float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum())), v) for v, y in rows if v != q)
        out[q] = near[:k]
    return out


def test_cells_come_by_distance():
    rng = np.random.default_rng(4)
    first, second = rng.random(7), rng.integers(0, 3, 9).astype(float)
    cells = list(neighbours.cells_by_distance(first, second))
    assert sorted(cells) == sorted(itertools.product(range(7), range(9)))
    sums = [first[i] + second[j] for i, j in cells]
    assert sums == sorted(sums)


def test_all_cells_give_exact_neighbours(spark):
    rng = np.random.default_rng(7)
    points = rng.normal(size=(300, 6)).round(1)
    points[40:90] = points[3]  # one very common vector
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    frame = spark.createDataFrame([(i, p, 1, 2.0) for i, p in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=5, centroids=8, visited_share=1.0, block_rows=16).collect()
    want = exact(rows, rows[::20], 5)
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert {q: [v for _, v in near] for q, near in by_query.items()} == {q: [v for _, v in near] for q, near in want.items()}
    assert all(abs(a - b) < 1e-12 for q in want for (a, _), (b, _) in zip(by_query[q], want[q], strict=True))


def clustered(n, seed=2):
    """Vectors around a tenth as many centres."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 10, 16))
    return centres[rng.integers(0, len(centres), n)] + rng.normal(scale=0.2, size=(n, 16))


@pytest.mark.parametrize("points, most", [(500, 0.9), (2000, 0.65), (clustered(2000), 0.2), (clustered(12000), 0.05)], ids=["500", "2000", "clustered 2000", "clustered 12000"])
def test_recall_of_the_visited_share(spark, monkeypatch, points, most):
    """A recall of 0.9 against brute force, with fewer vectors visited the more there are and the more structure they have."""
    if isinstance(points, int):
        sf = {500: "0.01", 2000: "0.1"}[points]
        frame = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet")
    else:
        frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    matrix, ids = np.array([x for _, x in rows], np.float64), np.array([i for i, _ in rows])
    measured, visited = neighbours._wanted, []
    monkeypatch.setattr(neighbours, "_wanted", lambda *a: visited.append(measured(*a)) or visited[-1])
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q, x in rows:
        if q % 100 == 0:
            d = ((matrix - x) ** 2).sum(1)
            d[ids == q] = np.inf
            near = set(ids[np.argsort(d, kind="stable")[:10]].tolist())
            hits, total = hits + len(near & got[q]), total + len(near)
    assert hits / total >= 0.9
    assert visited[0] <= most * len(rows)


def test_centroids_are_fitted_a_part_at_a_time():
    """The distances of a sample to all centroids would be the driver's largest table."""
    points = np.random.default_rng(1).normal(size=(20_000, 4))
    tracemalloc.start()
    neighbours.k_means(points, 1024, 3, rounds=1)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6


def test_driver_gets_no_row_for_a_cell(spark, monkeypatch):
    """Counts of up to a million cells reach the driver as numbers, not as rows."""
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(clustered(500))], "vec_id long, embedding array<float>")
    collect, rows = type(frame).collect, []
    monkeypatch.setattr(type(frame), "collect", lambda self: rows.append(collect(self)) or rows[-1])
    found = neighbours.nearest(frame, F.col("vec_id") < 3)
    monkeypatch.undo()
    assert found.count() == 30
    assert all(len(some) <= 1 for some in rows)


def test_reaches_visit_the_cells_of_the_heap():
    rng = np.random.default_rng(6)
    firsts, seconds = rng.random((4, 40)), rng.random((4, 50))
    held = rng.integers(0, 4, (40, 50)) * rng.integers(0, 2, (40, 50))
    for wanted in (1, 17, 900, held.sum()):
        for close in (1, 256, 5000):
            for first, second, sum_ in zip(firsts, seconds, neighbours.reaches(firsts, seconds, held, wanted, close), strict=True):
                seen, cells = 0, set()
                for p, q in neighbours.cells_by_distance(first, second):
                    cells.add((p, q))
                    seen += held[p, q]
                    if seen >= wanted:
                        break
                assert {(p, q) for p in range(40) for q in range(50) if first[p] + second[q] <= sum_} == cells
    assert np.isinf(neighbours.reaches(firsts, seconds, held, held.sum() + 1)).all()


@pytest.mark.parametrize("cells, scale", [(2, 1.0), (300, 1.0), (2, 1e30), (300, 1e-30)], ids=["few cells", "many cells", "large", "small"])
def test_blocks_meet(cells, scale):
    """All blocks of a list against the nearest of the vectors that lie in visited cells, ids that come again among them."""
    rng = np.random.default_rng(9)
    books = neighbours.Codebooks(3, rng.normal(size=(2, 3)) * scale, rng.normal(size=(cells, 5)) * scale)
    points, queries = rng.normal(size=(600, 8)) * scale, rng.normal(size=(300, 8)) * scale
    queries[0] = points[0]
    ids, own = rng.integers(0, 90, 600), np.arange(1000, 1300)
    own[:20] = np.arange(20)
    first, second = books.distances(queries)
    sums = np.quantile(first[:, :, None] + second[:, None, :], 0.7, axis=(1, 2))
    asked = neighbours.Asked(own, queries, sums, books, 5)
    cell = rng.integers(0, cells, 600)
    for part in np.array_split(np.arange(600), 4):
        part = part[np.argsort(cell[part], kind="stable")]
        asked.meet(1, cell[part].astype(np.int32), points[part], np.ones(len(part), np.int32), ids[part])
    rows = asked.best.rows().to_pylist()
    want = []
    for i in range(300):
        near = {}
        for j in np.flatnonzero(second[i][cell] <= (sums[i] - first[i][1])):
            score = float(np.sqrt(((points[j] - queries[i]) ** 2).sum()))
            if ids[j] != own[i] and score < near.get(ids[j], np.inf):
                near[ids[j]] = score
        want += [{"query_id": own[i], "vec_id": v, "score": s} for s, v in sorted((s, v) for v, s in near.items())[:5]]
    assert rows == want


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [0.0, 1.0]), (7, [0.0, 1.0]), (8, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (9, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(frame, F.lit(True), k=10).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 7), (1, 1, 0), (1, 2, 7), (7, 1, 0), (7, 2, 1)]
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest(frame, F.lit(False)).count() == 0
    assert neighbours.nearest(frame.where("vec_id = 0"), F.lit(True)).count() == 0
