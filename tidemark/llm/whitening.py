"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Vectors are read as integers, so their scatter is an integer matrix, summed exactly over
the distinct ones.  Its characteristic polynomial is worked out modulo many primes, each
by a reduction to Hessenberg form, and put together by Chinese remaindering.  The roots
are real, as the matrix is symmetric, so the sign changes of the polynomial moved to a
place count the roots above it: this isolates the largest ones, and halving refines them
to any precision.  The components are the null vectors of the matrix less a root, by
inverse iteration in integers of a few hundred bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import giving_back, stored

#: Sums travel as digits of this many bits, so that no sum of a column overflows.
LIMB_BITS = 40
#: Bits after the point of a root, beyond those of the largest one, and of the elimination.
ROOT_BITS, WORK_BITS = 160, 320
LARGEST_PRIME = (1 << 31) - 1


@dataclass(frozen=True)
class Scatter:
    """n vectors with sums S, and n times their products less S times S: n squared times their covariance."""

    n: int
    sums: tuple[int, ...]
    matrix: tuple[tuple[int, ...], ...]

    @property
    def trace(self) -> int:
        return sum(self.matrix[i][i] for i in range(len(self.sums)))


@dataclass(frozen=True)
class Component:
    """A unit eigenvector; its eigenvalue is ``root`` of the scatter over n squared."""

    vector: np.ndarray
    root: Fraction


# --- integers and their scatter -----------------------------------------------------------


def whole(vector: Column) -> Column:
    """Vectors without null, NaN or infinite entries."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integer_vectors(embeddings: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id and x, the floors of ``scale`` times the entries; whole vectors of the commonest length only."""
    read = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where(whole(F.col("v")))
    rows = read.select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("long")).alias("x"))
    length = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), "length").select("length").head()
    return rows.where(F.size("x") == (length[0] if length else 0)).where(F.size("x") > 0)


def matrix_of(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows of 64-bit integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def products(x: np.ndarray) -> np.ndarray:
    """Exact sums of products, with a leading column of ones, as Python integers."""
    x = np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1)
    largest = max(int(x.max()), -int(x.min()))
    rows = (1 << 53) // (largest * largest)
    if rows < 1:
        x = x.astype(object)
        return x.T @ x
    total = np.zeros((x.shape[1], x.shape[1]), object)
    for start in range(0, len(x), rows):
        part = x[start : start + rows].astype(np.float64)  # sums below 2^53 are exact in double precision
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def sums_of_products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, j, limb, digit) of the sums of a task; place 0 stands for the constant one."""
    total = None
    for batch in batches:
        if batch.num_rows:
            part = products(matrix_of(batch.column("x")))
            total = part if total is None else total + part
    if total is None:
        return
    mask, out = (1 << LIMB_BITS) - 1, []
    for i in range(len(total)):
        for j in range(i, len(total)):
            value, limb = int(total[i, j]), 0
            # The last digit keeps the sign.
            while not -(1 << LIMB_BITS) < value < 1 << LIMB_BITS:
                out.append((i, j, limb, value & mask))
                value, limb = value >> LIMB_BITS, limb + 1
            out.append((i, j, limb, value))
    columns = [pa.array(values, type_) for values, type_ in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)]
    yield pa.RecordBatch.from_arrays(columns, ["i", "j", "limb", "digit"])


def scatter_of(vectors: DataFrame) -> Scatter | None:
    """Exact scatter of the integer vectors x, all of one length; None without any.

    Tasks sum their own rows and Spark adds the sums, so what reaches the driver are a few
    digits for each pair of dimensions, however many rows there are.
    """
    digits = vectors.select("x").mapInArrow(sums_of_products, "i int, j int, limb int, digit long")
    summed = digits.groupBy("i", "j", "limb").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit")).collect()
    if not summed:
        return None
    d = 1 + max(r["j"] for r in summed)
    total = [[0] * d for _ in range(d)]
    for r in summed:
        total[r["i"]][r["j"]] += int(r["digit"]) << (LIMB_BITS * r["limb"])
    n, sums = total[0][0], tuple(total[0][1:])
    product = lambda i, j: total[min(i, j) + 1][max(i, j) + 1]
    matrix = tuple(tuple(n * product(i, j) - sums[i] * sums[j] for j in range(d - 1)) for i in range(d - 1))
    return Scatter(n, sums, matrix)


# --- the characteristic polynomial ----------------------------------------------------------


def is_prime(n: int) -> bool:
    """Whether an odd n below 2^32 is prime (Miller-Rabin; the bases 2, 7 and 61 suffice there)."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, largest first, until their product is more than ``bound``."""
    primes, product, n = [], 1, LARGEST_PRIME
    while product <= bound:
        if is_prime(n):
            primes.append(n)
            product *= n
        n -= 2
    return primes


def to_hessenberg(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to the given one modulo p, with zeros below the first subdiagonal."""
    h = matrix.copy()
    for k in range(len(h) - 2):
        nonzero = np.flatnonzero(h[k + 1 :, k])
        if not len(nonzero):
            continue
        pivot = k + 1 + int(nonzero[0])
        if pivot != k + 1:
            h[[pivot, k + 1]] = h[[k + 1, pivot]]
            h[:, [pivot, k + 1]] = h[:, [k + 1, pivot]]
        factors = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        # Rows below lose multiples of the pivot's row; its column gains the same multiples of theirs.
        h[k + 2 :] = (h[k + 2 :] - factors[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factors % p).sum(1)) % p
    return h


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients modulo p of det(t - matrix), the constant one first."""
    h, d = to_hessenberg(matrix, p), len(matrix)
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for k in range(1, d + 1):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polynomials[k - 1, :-1]
        new = (new - h[k - 1, k - 1] * polynomials[k - 1]) % p
        chain, weights = 1, np.zeros(k - 1, np.int64)
        for i in range(k - 2, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            weights[i] = chain * int(h[i, k - 1]) % p
        if k > 1:
            new = (new - (weights[:, None] * polynomials[: k - 1] % p).sum(0)) % p
        polynomials[k] = new
    return polynomials[d]


def remaindered(residues: list[tuple[int, list[int]]]) -> list[int]:
    """The integers with these residues (prime, one for each), nearest to zero."""
    modulus, values = 1, [0] * len(residues[0][1])
    for p, remainders in residues:
        inverse = pow(modulus, -1, p)
        values = [v + modulus * ((r - v) * inverse % p) for v, r in zip(values, remainders, strict=True)]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in values]


def characteristic_polynomial(spark: SparkSession, scatter: Scatter) -> list[int]:
    """Exact coefficients of det(t - matrix), the constant one first; the primes are dealt to tasks."""
    d, trace = len(scatter.sums), scatter.trace
    # Roots are not negative, so no coefficient is beyond this power of one more than their mean.
    primes = primes_beyond(2 * (2 + trace // d) ** d)
    matrix = scatter.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("p").to_pylist():
                reduced = np.array([[value % p for value in row] for row in matrix], np.int64)
                yield pa.RecordBatch.from_pydict({"p": pa.array([p], pa.int64()), "residues": pa.array([polynomial_mod(reduced, p).tolist()], pa.list_(pa.int64()))})

    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    rows = dealt.mapInArrow(run, "p long, residues array<long>").collect()
    return remaindered([(r["p"], r["residues"]) for r in rows])


# --- its roots --------------------------------------------------------------------------------


def value_at(polynomial: list[int], m: int, bits: int) -> int:
    """The value at m / 2^bits, times 2^(bits * degree)."""
    value, shift = 0, 0
    for c in reversed(polynomial):
        value = value * m + (c << shift)
        shift += bits
    return value


def roots_above(polynomial: list[int], m: int, bits: int) -> int:
    """Roots greater than m / 2^bits, each as often as it counts.

    Of a polynomial with real roots only, the sign changes of its coefficients are as many
    as its positive roots (Descartes; exact there), also when moved to another origin.
    """
    degree = len(polynomial) - 1
    c = [value << (bits * (degree - i)) for i, value in enumerate(polynomial)]
    for i in range(degree):
        for j in range(degree - 1, i - 1, -1):
            c[j] += m * c[j + 1]
    signs = [value > 0 for value in c if value]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(polynomial: list[int], count: int, bits: int) -> list[tuple[int, int]]:
    """The largest roots, falling, as m of the interval (m, m + 1] / 2^bits, with m + 1 for exact ones at its end.

    Returns pairs (numerator, 2^bits).  Each is halved by counting roots until it is alone
    in its interval, then by the sign of the polynomial; equal or very close roots are
    told apart by counting alone, down to the last bit.
    """
    # All roots are at most their sum.
    top = max(-polynomial[-2], 0).bit_length() if len(polynomial) > 1 else 0
    found = []
    for k in range(1, count + 1):
        low, low_count, high, high_count, scale = -1, len(polynomial) - 1, 1 << top, 0, 0
        while scale < bits or high - low > 1:
            if high - low == 1:
                low, high, scale = 2 * low, 2 * high, scale + 1
            middle = (low + high) // 2
            if low_count - high_count == 1:
                # Alone in (low, high]: above it the sign differs from that at or below.
                sign = value_at(polynomial, middle, scale)
                above = sign != 0 and (sign > 0) == (high_count % 2 == 1)
            else:
                n_above = roots_above(polynomial, middle, scale)
                above = n_above >= k
                if above:
                    low_count = n_above
                else:
                    high_count = n_above
            low, high = (middle, high) if above else (low, middle)
        found.append((high, 1 << bits))
    return found


# --- its components ---------------------------------------------------------------------------


def null_vector(matrix: tuple[tuple[int, ...], ...], root: tuple[int, int], earlier: list[list[int]], number: int) -> list[int]:
    """A vector of length 2^WORK_BITS that ``matrix`` less ``root`` takes to almost nothing, at right angles to ``earlier``.

    Inverse iteration: the elimination is done once, in integers with WORK_BITS after the
    point; each round solves with it and makes the result orthogonal and of unit length.
    """
    d, (numerator, denominator), unit = len(matrix), root, 1 << WORK_BITS
    a = np.array([[value * denominator - (numerator if i == j else 0) for j, value in enumerate(row)] for i, row in enumerate(matrix)], object)
    order, factors = list(range(d)), np.zeros((d, d), object)
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            for m in (a, factors):
                m[[k, pivot]] = m[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if not a[k, k]:
            a[k, k] = 1  # an exact root; the solution grows along its null vector
        if k + 1 < d:
            f = (a[k + 1 :, k] << WORK_BITS) // a[k, k]
            factors[k + 1 :, k] = f
            a[k + 1 :, k:] -= (f[:, None] * a[k, k:]) >> WORK_BITS
            a[k + 1 :, k] = 0

    def unit_length(v: list[int]) -> list[int]:
        for other in earlier * 2:
            along = sum(x * y for x, y in zip(v, other, strict=True)) >> WORK_BITS
            v = [x - (along * y >> WORK_BITS) for x, y in zip(v, other, strict=True)]
        length = isqrt(sum(x * x for x in v))
        return [(x << WORK_BITS) // length for x in v]

    # Any start will do that is not at right angles to the vector wanted.
    start = np.random.default_rng(number).integers(-(1 << 30), 1 << 30, d)
    v = unit_length([int(x) << WORK_BITS for x in start])
    for _ in range(4):
        b = np.array([v[i] for i in order], object) << WORK_BITS
        for k in range(d):
            b[k + 1 :] -= (factors[k + 1 :, k] * b[k]) >> WORK_BITS
        solved = [0] * d
        for k in range(d - 1, -1, -1):
            rest = sum(a[k, j] * solved[j] for j in range(k + 1, d)) >> WORK_BITS
            solved[k] = ((b[k] - rest) << WORK_BITS) // a[k, k]
        v = unit_length(solved)
    return v


def components_of(scatter: Scatter, polynomial: list[int], count: int = 4) -> list[Component]:
    """The components of largest eigenvalue, falling; none for eigenvalues that are zero.

    An eigenvalue of zero is exact: as many of the last coefficients are zero.
    """
    rank = len(polynomial) - 1 - next(i for i, c in enumerate(polynomial) if c)
    bits = ROOT_BITS
    vectors: list[list[int]] = []
    out = []
    for number, root in enumerate(largest_roots(polynomial, min(count, rank), bits)):
        vectors.append(null_vector(scatter.matrix, root, vectors, number))
        out.append(Component(np.array([x / (1 << WORK_BITS) for x in vectors[-1]]), Fraction(*root)))
    return out


# --- whitening ----------------------------------------------------------------------------------


def projections(scatter: Scatter, parts: list[Component]) -> tuple[np.ndarray, np.ndarray]:
    """Means of the dimensions, and components over the roots of their eigenvalues, as columns."""
    mean = np.array([s / scatter.n for s in scatter.sums])
    # Correctly rounded quotients of integers.
    values = [c.root.numerator / (c.root.denominator * scatter.n**2) for c in parts]
    return mean, np.stack([c.vector for c in parts], 1) / np.sqrt(np.array(values))


def identity_error(fitted: DataFrame, mean: np.ndarray, columns: np.ndarray) -> float:
    """Largest entry of the whitened vectors' covariance less the identity; two passes, centred before multiplying."""
    k = columns.shape[1]

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = (matrix_of(batch.column("x")) - mean) @ columns
                yield pa.RecordBatch.from_pydict({"i": pa.array(range(k), pa.int32()), "rows": pa.array([len(w)] * k, pa.int64()), "value": pa.array(w.sum(0))})

    total = fitted.select("x").mapInArrow(means, "i int, rows long, value double").groupBy("i").agg(F.sum("rows").alias("rows"), F.sum("value").alias("value"))
    rows = {r["i"]: (r["rows"], r["value"]) for r in total.collect()}
    n, centre = rows[0][0], np.array([rows[i][1] / rows[i][0] for i in range(k)])

    def covariances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                w = (matrix_of(batch.column("x")) - mean) @ columns - centre
                yield pa.RecordBatch.from_pydict({"i": pa.array(range(k * k), pa.int32()), "value": pa.array((w.T @ w).reshape(-1))})

    sums = fitted.select("x").mapInArrow(covariances, "i int, value double").groupBy("i").agg(F.sum("value").alias("value")).collect()
    return max(abs(r["value"] / n - (r["i"] // k == r["i"] % k)) for r in sums)


def whitened(embeddings: DataFrame, count: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """Every vector on the ``count`` components of largest variance, each scaled to variance one.

    Returns, for each row and component, vec_id, component (from 1, by falling eigenvalue),
    n, deviation, whitened, explained, identity_error and deviation_exact.  Vectors are
    fitted as integers, the floors of ``scale`` times their entries, each different one
    once: n of them, with covariance V (divisor n).  ``deviation`` is the sum of
    (n * x - S)^2 over the dimensions, exact; it is null where that passes a long, and
    ``deviation_exact`` holds it as text.  ``whitened`` is the projection of x less the mean
    on the component over the root of its eigenvalue, ``explained`` that eigenvalue over the
    trace of V, and ``identity_error`` how far the whitened vectors' covariance is from the
    identity.

    Vectors that are null, empty or hold null, NaN or infinite entries are dropped, and those of
    another length than most (the shorter, if equally many).  Null and repeated ids stay,
    each row for itself.  Entries whose floor passes a long count as the nearest long.  A
    component without variance has no scale, so it is left out: equal vectors only, as an empty
    table, give no rows.  Equal eigenvalues have any orthonormal components of their space.

    Only the id and the vector are read, so extra columns may have any name.  What the
    driver does depends on the dimensions alone: seconds for 64, with the cube of them.
    """
    spark = embeddings.sparkSession
    rows = integer_vectors(embeddings, id_col, vector_col, scale)
    fitted = stored(rows.select("x").distinct(), "distinct-vectors")
    scatter = scatter_of(fitted)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
    if scatter is None or not scatter.trace:
        return spark.createDataFrame([], schema)
    parts = components_of(scatter, characteristic_polynomial(spark, scatter), count)
    mean, columns = projections(scatter, parts)
    error = identity_error(fitted, mean, columns)
    k, n, sums, trace = len(parts), scatter.n, scatter.sums, scatter.trace
    explained = [c.root.numerator / (c.root.denominator * trace) for c in parts]
    most = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix_of(batch.column("x"))
            largest = max(int(x.max()), -int(x.min())) * n + max(map(abs, sums))
            # Integers of the machine where no sum of squares can pass them.
            kind = np.int64 if largest * largest * x.shape[1] <= most else object
            off = x.astype(kind) * n - np.array(sums, kind)
            exact = [int(v) for v in (off * off).sum(1)]
            taken = batch.take(pa.array(np.repeat(np.arange(len(x)), k)))
            each = lambda values, type_: pa.array([v for v in values for _ in range(k)], type_)
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column("vec_id"),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n)),
                    each([v if v <= most else None for v in exact], pa.int64()),
                    pa.array(((x - mean) @ columns).reshape(-1)),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                    each(map(str, exact), pa.string()),
                ],
                names,
            )

    names = [field.split()[0] for field in schema.split(", ")]
    return rows.mapInArrow(giving_back(run), schema)
