"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised by its own centroids; the pair of nearest
centroids is the cell of a vector.  A query visits cells by the sum of its distances to
the two centroids, smallest first, until the cells hold as many vectors as asked; these
are ranked by their true distances.  The cells up to a sum are counted, the last of them
are taken from a heap.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from tidemark.llm.common import giving_back, stored

#: Rows whose distances to all centroids are held at a time.
CHUNK = 1024

#: For large values: a page is closed after any row, not after a hundred, and a reader
#: holds none of it twice for the sake of a compression that does little for vectors.
PAGES = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1"}


@dataclass(frozen=True)
class Codebooks:
    """Centroids of the two halves; ``split`` is the length of the first."""

    split: int
    first: np.ndarray
    second: np.ndarray

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves to their centroids."""
        halves = (vectors[:, : self.split], self.first), (vectors[:, self.split :], self.second)
        out = []
        for x, c in halves:
            squares = (-2 * x) @ c.T
            squares += (x * x).sum(1)[:, None]
            squares += (c * c).sum(1)
            out.append(np.maximum(squares, 0, out=squares))
        return tuple(out)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids of the halves."""
        near = [[d.argmin(1) for d in self.distances(vectors[i : i + CHUNK])] for i in range(0, len(vectors), CHUNK)]
        return tuple(np.concatenate(x).astype(np.int32) for x in zip(*near, strict=True))


def k_means(points: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Centroids of a bounded sample; fewer when there are fewer distinct points."""
    points = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        squares = (centres * centres).sum(1)
        near = np.concatenate([(squares - 2 * points[i : i + CHUNK] @ centres.T).argmin(1) for i in range(0, len(points), CHUNK)])
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def usable(vector: Column) -> Column:
    """Vectors without null or non-finite components that are not all zero."""
    # The search is unknown beside a null.
    whole = ~F.array_contains(vector, F.lit(float("nan")))
    least, most = F.array_min(vector), F.array_max(vector)
    finite = (least > float("-inf")) & (most < float("inf"))
    return F.coalesce((F.size(vector) > 0) & whole & finite & ((least != 0) | (most != 0)), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1).astype(np.float64)


def _unpacked(column: pa.Array, kind: np.dtype, width: int) -> np.ndarray:
    """A vector for each value."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def fit_codebooks(vectors: DataFrame, rows: int, centroids: int, sample_rows: int, seed: int) -> tuple[Codebooks, np.ndarray] | None:
    """Centroids from at most ``sample_rows`` of the ``rows`` vectors, the first by a hash of their values; and these, each once."""
    hashed = vectors.select("vector", F.xxhash64(F.col("vector").cast("array<double>"), F.lit(seed)).alias("hashed"))
    share = 1.2 * sample_rows / max(rows, 1)
    while True:
        # Only the smallest hashes are gathered; more of them where these are too few.
        within = hashed.where(F.col("hashed") < int(2**64 * share) - 2**63) if share < 0.9 else hashed
        sample = within.groupBy("hashed", "vector").agg(F.count("*").alias("n")).orderBy("hashed", "vector").limit(sample_rows).toArrow()
        counts = sample.column("n").to_numpy()
        if share >= 0.9 or counts.sum() >= sample_rows:
            break
        share *= 4
    if not sample.num_rows:
        return None
    points = _matrix(sample.column("vector").combine_chunks())[np.cumsum(counts) - counts < sample_rows]
    split = points.shape[1] // 2 or points.shape[1]
    return Codebooks(split, k_means(points[:, :split], centroids, seed), k_means(points[:, split:], centroids, seed + 1)), points


def cells_by_distance(first: np.ndarray, second: np.ndarray, front: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of centroids by the sum of their distances, each once.

    A pair enters the heap when both its neighbours nearer along the two sorted lists
    have left it, so the heap holds no more than a front of them.  With ``front``, which
    says for each centroid of the sorted first list how many of the second list have been
    taken, the pairs that follow.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    done = np.zeros(len(rows), np.int64) if front is None else front.copy()
    heap = [(first[rows[i]] + second[columns[done[i]]], i, int(done[i])) for i in range(len(rows)) if done[i] < len(columns) and (i == 0 or done[i - 1] > done[i])]
    heapq.heapify(heap)
    while heap:
        _, i, j = heapq.heappop(heap)
        yield int(rows[i]), int(columns[j])
        done[i] = j + 1
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(rows) and q < len(columns) and (p == 0 or done[p - 1] > q) and done[p] == q:
                heapq.heappush(heap, (first[rows[p]] + second[columns[q]], p, q))


def reaches(firsts: np.ndarray, seconds: np.ndarray, held: np.ndarray, wanted: int, close: int = 256) -> np.ndarray:
    """For each query a sum of distances between that of the last cell it visits and the next.

    The cells up to a sum are a front over the two sorted lists.  Bisection finds a front
    that holds less than ``wanted`` vectors, ``close`` cells or so before the last, and
    the heap goes on from there.
    """
    taken, within = np.empty_like(held), np.zeros((held.shape[0], held.shape[1] + 1), np.int64)
    out = np.full(len(firsts), np.inf)
    if held.sum() < wanted:
        return out
    for number, (first, second) in enumerate(zip(firsts, seconds, strict=True)):
        rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        near, sums = first[rows], second[columns]
        np.cumsum(np.take(held, columns, axis=1, out=taken, mode="clip"), axis=1, out=within[:, 1:])
        low, least = np.zeros(len(near), np.int64), near[0] + sums[0]
        high, most = np.full(len(near), len(sums)), near[-1] + sums[-1]
        for _ in range(60):
            if (high - low).sum() <= close:
                break
            middle = (least + most) / 2
            front = np.searchsorted(sums, middle - near, side="right")
            if within[rows, front].sum() < wanted:
                low, least = front, middle
            else:
                high, most = front, middle
        seen, last = within[rows, low].sum(), None
        for p, q in cells_by_distance(first, second, low):
            here = first[p] + second[q]
            if last is not None and here > last:
                out[number] = (last + here) / 2
                break
            seen += held[p, q]
            if last is None and seen >= wanted:
                last = here
    return out


def centroids_for(vectors: int) -> int:
    """A power of two, so that there are at least as many cells as vectors; a million cells at most."""
    return int(min(1024, 2 ** np.ceil(np.log2(max(vectors, 1)) / 2)))


def _wanted(index: DataFrame, probes: np.ndarray, kind: np.dtype, books: Codebooks, held: np.ndarray, k: int, recall: float) -> int:
    """How many vectors a query has to visit for the recall, measured on the probes.

    The nearest vectors of each probe are found among all vectors.  The vectors that lie in
    cells up to that of a neighbour are what finding it costs; the recall asked for is a
    quantile of these.
    """
    width = len(books.second)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, cells = np.empty((len(probes), 0)), np.empty((len(probes), 0), np.int32)
        for batch in batches:
            for i in range(batch.num_rows):
                vectors = np.frombuffer(batch.column("vectors")[i].as_buffer(), kind).reshape(-1, probes.shape[1]).astype(np.float64)
                cell = batch.column("list")[i].as_py() * width + np.frombuffer(batch.column("seconds")[i].as_buffer(), np.int32)
                scores = np.hstack([scores, (vectors * vectors).sum(1) - 2 * probes @ vectors.T])
                cells = np.hstack([cells, np.broadcast_to(cell, (len(probes), len(cell)))])
                if scores.shape[1] > k + 1:
                    best = np.argpartition(scores, k, axis=1)[:, : k + 1]
                    scores, cells = np.take_along_axis(scores, best, 1), np.take_along_axis(cells, best, 1)
        number = np.repeat(np.arange(len(probes), dtype=np.int32), scores.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(scores.reshape(-1)), pa.array(cells.reshape(-1).astype(np.int32))], ["probe", "score", "cell"])

    # The probe itself is one of the k + 1.
    near = index.select("list", "seconds", "vectors").mapInArrow(scan, "probe int, score double, cell int")
    rank = F.row_number().over(Window.partitionBy("probe").orderBy("score", "cell"))
    found = near.withColumn("rank", rank).where(F.col("rank").between(2, k + 1)).select("probe", "cell").toArrow()  # k for each probe
    first, second = books.distances(probes)
    costs = []
    for number in range(len(probes)):
        order = np.argsort((first[number][:, None] + second[number][None, :]).reshape(-1), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        cells = found.column("cell").to_numpy()[found.column("probe").to_numpy() == number]
        costs += np.cumsum(held.reshape(-1)[order])[place[cells]].tolist()
    return max(k + 1, int(np.quantile(costs, recall, method="higher"))) if costs else k + 1


def _thinned(hashes: np.ndarray, ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Places of the rows without those of vectors that are there more often, whose ``most`` smallest ids stay."""
    order = np.lexsort((ids, hashes))
    starts = np.flatnonzero(np.r_[True, np.diff(hashes[order]) != 0])
    sizes = np.diff(np.r_[starts, len(order)])
    keep = np.ones(len(order), bool)
    for start, size in zip(starts[sizes > most], sizes[sizes > most], strict=True):
        at = order[start : start + size]
        if (vectors[at] == vectors[at[0]]).all():
            keep[at] = False
            keep[at[np.unique(ids[at], return_index=True)[1][:most]]] = True
    return np.flatnonzero(keep)


class Best:
    """The k nearest ids found so far for each of some queries; ties to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.own, self.k = ids, k
        self.ids, self.scores = np.zeros((len(ids), k), np.int64), np.full((len(ids), k), np.inf)
        self.have = np.zeros(len(ids), np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take in ids with scores for rows of queries; an id counts once, its row's own not at all."""
        rows, ids, scores = (x[ids != self.own[rows]] for x in (rows, ids, scores))
        there = np.unique(rows)
        old = np.arange(self.k) < self.have[there, None]
        rows = np.concatenate([np.repeat(there, self.have[there]), rows])
        ids, scores = np.concatenate([self.ids[there][old], ids]), np.concatenate([self.scores[there][old], scores])
        order = np.lexsort((scores, ids, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        once = np.r_[True, (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1])][: len(rows)]
        rows, ids, scores = rows[once], ids[once], scores[once]
        order = np.lexsort((ids, scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        starts = np.searchsorted(rows, there)
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.r_[starts, len(rows)]))
        kept = rank < self.k
        self.ids[rows[kept], rank[kept]], self.scores[rows[kept], rank[kept]] = ids[kept], scores[kept]
        self.have[there] = np.minimum(np.diff(np.r_[starts, len(rows)]), self.k)

    def limits(self) -> np.ndarray:
        """Squared distances from which on a vector is too far."""
        return np.where(self.have == self.k, self.scores[:, -1] ** 2 * (1 + 1e-12), np.inf)

    def rows(self) -> pa.RecordBatch:
        there = np.arange(self.k) < self.have[:, None]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.own, self.have)), pa.array(self.ids[there]), pa.array(self.scores[there])], ["query_id", "vec_id", "score"])


class Asked:
    """A block of queries: their distances to all centroids, how far each reaches, and what was found."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, reaches: np.ndarray, books: Codebooks, k: int):
        self.vectors, self.best = vectors.astype(np.float64), Best(ids, k)
        first, second = books.distances(self.vectors)
        self.seconds = np.ascontiguousarray(second.T)
        self.room = np.ascontiguousarray((reaches[:, None] - first).T)
        self.nearest = second.min(1)
        self.squares = (self.vectors * self.vectors).sum(1)
        self.limits = self.best.limits()

    def meet(self, list_: int, seconds: np.ndarray, vectors: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Rank the vectors of a block of one list, in the order of their cells, for the queries that visit these."""
        asking = np.flatnonzero(self.room[list_] >= self.nearest)
        starts = np.flatnonzero(np.r_[True, seconds[1:] != seconds[:-1]])
        distances = self.seconds[seconds[starts]]
        visited = (distances if len(asking) == len(self.nearest) else distances[:, asking]) <= self.room[list_][asking]
        some = visited.any(0)
        if not some.all():
            asking, visited = asking[some], visited[:, some]
        if not len(asking):
            return
        sizes = np.diff(np.r_[starts, len(seconds)])
        open_ = visited.any(1)
        at, visited, sizes = np.flatnonzero(np.repeat(open_, sizes)), visited[open_], sizes[open_]
        cell, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
        points = vectors[at].astype(np.float64)
        squares, own = (points * points).sum(1), self.squares[asking]
        # Products are taken in single precision where their error can be bounded; what
        # is not surely too far is measured again in double precision.
        small, large = min(own.min(), squares.min()), max(own.max(), squares.max())
        kind = np.float32 if 1e-20 < small and large < 1e20 else np.float64
        error = (points.shape[1] + 16) * float(np.finfo(kind).eps)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        with np.errstate(all="ignore"):
            right = np.vstack([points.T, squares * (1 - error)]).astype(kind)
            left = np.hstack([-2 * self.vectors[asking], np.ones((len(asking), 1))]).astype(kind)
            limit = np.nextafter((self.limits[asking] - own * (1 - error)).astype(kind), kind(np.inf))
            bounded = np.isfinite(limit)
            busy, lacking = np.flatnonzero(bounded), np.flatnonzero(~bounded)
            seen = visited[:, busy] if len(lacking) else visited
            # All products at once, or those of one cell after the other: by nanoseconds of a product and a cell.
            if 4 * (seen.sum(1) @ sizes) + 13_000 * len(sizes) < 3 * len(busy) * len(at):
                for who, begin, end in zip(map(np.flatnonzero, seen), ends - sizes, ends, strict=True):
                    who = busy[who]
                    hit = np.flatnonzero(~(left[who] @ right[:, begin:end] > limit[who, None]))
                    if len(hit):
                        row, entry = np.divmod(hit, end - begin)
                        found.append((who[row], begin + entry))
            else:
                for i in range(0, len(busy), 128):
                    who = busy[i : i + 128]
                    hit = np.flatnonzero(~(left[who] @ right > limit[who, None]))
                    if len(hit):
                        row, entry = np.divmod(hit, len(at))
                        found.append((who[row], entry))
            if found:
                row, entry = (np.concatenate(x) for x in zip(*found, strict=True))
                self._measure(asking, row, entry, visited, cell, at, points, counts, ids)
            # Queries with fewer than k ids so far take the nearest they visit here, and more where ids come again.
            take = self.best.k + 1
            while len(lacking):
                far, seen = left[lacking] @ right, visited[:, lacking].T[:, cell]
                limit = np.full(len(lacking), np.inf)
                if take < len(at):
                    limit = np.partition(np.where(seen, far, kind(np.inf)), take, axis=1)[:, take] + 4 * error * (own[lacking] + squares.max())
                row, entry = np.nonzero(seen & ~(far > limit[:, None]))
                self._measure(asking, lacking[row], entry, visited, cell, at, points, counts, ids)
                lacking = lacking[np.isfinite(limit) & ~np.isfinite(self.limits[asking[lacking]])]
                take *= 4

    def _measure(self, asking: np.ndarray, row: np.ndarray, entry: np.ndarray, visited: np.ndarray, cell: np.ndarray, at: np.ndarray, points: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        seen = visited[cell[entry], row]
        row, entry = asking[row[seen]], entry[seen]
        if not len(row):
            return
        step = 4 * CHUNK
        scores = np.concatenate([np.sqrt(((points[entry[i : i + step]] - self.vectors[row[i : i + step]]) ** 2).sum(1)) for i in range(0, len(row), step)])
        n = counts[at[entry]]
        first = (np.cumsum(counts) - counts)[at[entry]]
        place = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        self.best.add(np.repeat(row, n), ids[place], np.repeat(scores, n))
        self.limits = self.best.limits()


def nearest(
    embeddings: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int | None = None,
    recall: float = 0.96,
    probes: int = 64,
    visited_share: float | None = None,
    sample_rows: int = 20_000,
    block_rows: int = 2048,
    seed: int = 3,
) -> DataFrame:
    """The k nearest vectors found for each row of ``embeddings`` where ``queries`` holds.

    Returns query_id, rank (from 1), vec_id and score: Euclidean distance in double
    precision on the vectors as given, ties to the smaller id.  Every row but the query's
    own is indexed and can be found.  The codebooks have ``centroids`` each, by default as
    the number of vectors asks for.  A query visits cells until they hold as many vectors
    as ``recall`` takes, which is measured: for up to ``probes`` of the queries, the first
    by a hash, the nearest vectors are looked up among all.  ``visited_share`` gives the
    share of the vectors to visit instead.

    Vectors that are null, zero or hold null or non-finite components take no part, nor
    do rows with a null id or of another length than most.  Of equal vectors the k + 1
    smallest ids are kept, as no other can be among the k nearest; a repeated id counts
    once for each different vector.  A table of k + 1 vectors or fewer is visited whole; an
    empty one gives no rows.  Only the id and the vector are read, so extra columns may
    have any name.
    """
    spark = embeddings.sparkSession
    # Arrays of single precision travel and are kept as such; all that is computed is in double precision.
    single = isinstance(embeddings.select(vector_col).schema[0].dataType.elementType, FloatType)
    kind = np.dtype(np.float32 if single else np.float64)
    read = (
        embeddings.withColumn("is_query", F.coalesce(queries, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"), "is_query")
        .where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    )
    length = read.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").select("length", "count").head()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions, rows = length["length"], length["count"]
    read = read.where(F.size("vector") == dimensions)
    fitted, sample = fit_codebooks(read, rows, centroids or centroids_for(rows), sample_rows, seed)
    # Arrays travel, so that workers need nothing of this package by name.
    books = spark.sparkContext.broadcast((fitted.split, fitted.first, fitted.second))
    width = len(fitted.second)
    # Vectors of a list, which is the cells of one first centroid, are dealt by a hash into
    # blocks of some block_rows, by the list's share of the sample.
    shares = np.bincount(fitted.cells(sample)[0], minlength=len(fitted.first)) / len(sample)
    blocks = spark.sparkContext.broadcast(np.maximum(1, np.ceil(shares * rows / block_rows)).astype(np.int64))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Values of a JVM above half a megabyte are collected late.
    most = max(1, min(block_rows, (384 << 10) // (dimensions * kind.itemsize)))

    @giving_back
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, hashes, ids = _matrix(batch.column("vector")) + 0.0, batch.column("hashed").to_numpy(), batch.column("vec_id").to_numpy()
                at = _thinned(hashes, ids, vectors, k + 1)
                first, second = Codebooks(*books.value).cells(vectors[at])
                packed = [row.tobytes() for row in vectors[at].astype(kind)]
                block = hashes[at] % blocks.value[first]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (first, block, second, hashes[at], ids[at])] + [pa.array(packed, pa.binary())], ["list", "block", "second", "hashed", "vec_id", "vector"])

    def entries_of(lists: np.ndarray, seconds: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows without repeats and ids beyond the k + 1 smallest of a vector, and the first rows of vectors."""
        new = np.r_[True, (lists[1:] != lists[:-1]) | (seconds[1:] != seconds[:-1]) | (vectors[1:] != vectors[:-1]).any(1)]
        once = np.r_[True, new[1:] | (ids[1:] != ids[:-1])]
        entry = (np.cumsum(new) - 1)[once]
        starts = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]])
        kept = np.arange(len(entry)) - starts[entry] <= k
        at = np.flatnonzero(once)[kept]
        return at, np.flatnonzero(np.r_[True, np.diff(entry[kept]) != 0])

    @giving_back
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["list", "size", "seconds", "vectors", "counts", "ids"]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        rest: tuple[np.ndarray, ...] | None = None

        def blocks_of(rows: tuple[np.ndarray, ...], last: bool) -> tuple[list[tuple], tuple[np.ndarray, ...]]:
            lists, seconds, ids, vectors = rows
            at, starts = entries_of(*rows)
            lists, seconds, ids, vectors = lists[at], seconds[at], ids[at], vectors[at]
            ends, out, done = np.r_[starts[1:], len(lists)], [], 0
            edges = np.flatnonzero(np.r_[True, np.diff(lists[starts]) != 0])
            for begin, end in zip(edges, np.r_[edges[1:], len(starts)], strict=True):
                for i in range(begin, end, most):
                    j = min(i + most, end)
                    if j == len(starts) and not last:  # its last vector may go on
                        break
                    one = starts[i:j]
                    out.append((int(lists[one[0]]), j - i, seconds[one].tobytes(), vectors[one].tobytes(), (ends[i:j] - one).astype(np.int32).tobytes(), ids[one[0] : ends[j - 1]].tobytes()))
                    done = ends[j - 1]
            return out, (lists[done:], seconds[done:], ids[done:], vectors[done:])

        def as_batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, type_) for x, type_ in zip(zip(*out, strict=True), kinds, strict=True)], names)

        for batch in batches:
            if batch.num_rows:
                rows = tuple(batch.column(x).to_numpy() for x in ("list", "second", "vec_id")) + (_unpacked(batch.column("vector"), kind, dimensions),)
                out, rest = blocks_of(rows if rest is None else tuple(np.concatenate(x) for x in zip(rest, rows, strict=True)), False)
                if out:
                    yield as_batch(out)
        if rest is not None:
            yield as_batch(blocks_of(rest, True)[0])

    # A row of the index, or of a meeting, is near a megabyte, so few go into a batch: in a
    # session of its own, as the caller's settings are the caller's.
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    own.conf.set("spark.sql.parquet.columnarReaderBatchSize", "16")
    hashed = read.select("vec_id", "vector", F.xxhash64(F.col("vector").cast("array<double>")).alias("hashed"))
    dealt = hashed.mapInArrow(assign, "list int, block long, second int, hashed long, vec_id long, vector binary").repartition(partitions, "list", "block")
    ordered = dealt.sortWithinPartitions("list", "second", "hashed", "vector", "vec_id").select("list", "second", "vec_id", "vector")
    index = stored(ordered.mapInArrow(pack, "list int, size int, seconds binary, vectors binary, counts binary, ids binary"), "index", own, **PAGES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column("list")[i].as_py() * width + np.frombuffer(batch.column("seconds")[i].as_buffer(), np.int32) for i in range(batch.num_rows)]
            cell, n = np.unique(np.concatenate(cells) if cells else np.empty(0, np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(n.astype(np.int64))], ["cell", "n"])

    # One number for each pair of centroids.
    counted = index.select("list", "seconds").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros(len(fitted.first) * width, np.int64)
    held[counted.column("cell").to_numpy()] = counted.column("n").to_numpy()
    held = held.reshape(len(fitted.first), width)
    counts = spark.sparkContext.broadcast(held.astype(np.int32))
    asked = stored(read.where("is_query").select("vec_id", "vector").distinct(), "asked")
    if visited_share is not None:
        wanted = max(k + 1, int(np.ceil(visited_share * held.sum())))
    else:
        asking = asked.select("vector").distinct().orderBy(F.xxhash64(F.col("vector").cast("array<double>")), "vector").limit(probes).toArrow()
        wanted = _wanted(index, _matrix(asking.column("vector").combine_chunks()), kind, fitted, held, k, recall) if asking.num_rows else k + 1

    @giving_back
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, min(CHUNK, most)):
                part = batch.slice(i, min(CHUNK, most))
                vectors = _unpacked(part.column("vector"), kind, dimensions)
                first, second = Codebooks(*books.value).distances(vectors.astype(np.float64))
                sums = reaches(first, second, counts.value, wanted)
                lists = np.flatnonzero((sums[:, None] - first >= second.min(1)[:, None]).any(0))
                columns = [part.column("vec_id").to_numpy().tobytes(), vectors.tobytes(), sums.tobytes(), lists.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([x], type_) for x, type_ in zip(columns, (pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int32())), strict=True)], ["query_ids", "queries", "reaches", "lists"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column("vector"))
                first, second = Codebooks(*books.value).cells(vectors)
                packed = pa.array([row.tobytes() for row in vectors.astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed, pa.array(first), pa.array(second)], ["vec_id", "vector", "list", "second"])

    # Queries of near cells make a block, and visit much the same lists.
    placed = asked.mapInArrow(place, "vec_id long, vector binary, list int, second int")
    near = placed.repartitionByRange(max(1, min(partitions, -(-asked.count() // CHUNK))), "list", "second", "vec_id").sortWithinPartitions("list", "second", "vec_id").select("vec_id", "vector")
    visitors = stored(near.mapInArrow(visit, "query_ids binary, queries binary, reaches binary, lists array<int>"), "visitors", own, **PAGES)

    @giving_back
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, asking = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                one = {name: batch.column(name)[i].as_buffer() for name in ("query_ids", "queries", "reaches", "seconds", "vectors", "counts", "ids")}
                if (one["query_ids"], one["queries"]) != block:
                    if asking:
                        yield asking.best.rows()
                        asking = None
                    # A copy, as the batch is given up.
                    block = tuple(pa.py_buffer(one[x].to_pybytes()) for x in ("query_ids", "queries"))
                    points = np.frombuffer(block[1], kind).reshape(-1, dimensions)
                    asking = Asked(np.frombuffer(block[0], np.int64), points, np.frombuffer(one["reaches"], np.float64), Codebooks(*books.value), k)
                vectors = np.frombuffer(one["vectors"], kind).reshape(-1, dimensions)
                asking.meet(batch.column("list")[i].as_py(), np.frombuffer(one["seconds"], np.int32), vectors, np.frombuffer(one["counts"], np.int32), np.frombuffer(one["ids"], np.int64))
        if asking:
            yield asking.best.rows()

    # Each block of queries meets each block of a list that one of them visits. A task has
    # some 32 MB of the index in memory and takes one block of queries after the other.
    parts = max(1, -(-int(held.sum()) * (dimensions * kind.itemsize + 16) // (32 << 20)))
    groups = visitors.coalesce(max(1, -(-partitions // parts))).hint("shuffle_replicate_nl")
    meetings = groups.join(index.coalesce(parts), F.expr("array_contains(lists, list)")).drop("lists", "size")
    found = meetings.mapInArrow(rank, "query_id long, vec_id long, score double").repartition(partitions, "query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
