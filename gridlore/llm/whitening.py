"""Whitened embeddings, by the exact characteristic polynomial of the scatter matrix.

Entries become whole numbers, so the scatter matrix is exact. Its
characteristic polynomial is computed modulo many primes, in parallel, by
reduction to Hessenberg form, and put together by Chinese remaindering. All its
roots are real, so the sign changes of the polynomial moved to a point are
exactly as many as there are roots beyond it (Descartes); bisection by this
count isolates the roots and narrows them down far below double precision. Each
root's component is found by inverse iteration in fixed-point arithmetic.

Through the driver go only numbers whose count depends on the dimension.
"""
from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.sources.shared import materialize

# x = floor(SCALE * entry) + SHIFT; entries whose floor is further from 0 than FAR can't be used.
SCALE, SHIFT, FAR = 64, 1_000_000, 1 << 40
_HALF = 1 << 20
_ROWS = 2048  # so many products of two halves still add up exactly in doubles
_BITS = 256  # of fixed-point numbers, behind the point
_NARROW = 160  # roots are known to this many bits of the largest


def _whole(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable, and their entries as whole numbers without ``SHIFT``."""
    vectors = batch.column(1)
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = np.flatnonzero(sizes == dimension)
    flat = vectors.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
    values = flat.astype(np.float64).reshape(len(fits), dimension)
    with np.errstate(invalid="ignore", over="ignore"):
        values = np.floor(values * SCALE)
        good = (np.abs(values) <= FAR).all(axis=1)
    return fits[good], values[good].astype(np.int64)


def _scatter(y: np.ndarray) -> np.ndarray:
    """The sums of products of all pairs of columns, exactly."""
    low = (y + _HALF // 2) % _HALF - _HALF // 2
    high = ((y - low) // _HALF).astype(np.float64)
    low, total = low.astype(np.float64), np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), _ROWS):
        a, b = high[at : at + _ROWS], low[at : at + _ROWS]
        total += (b.T @ b).astype(np.int64).astype(object)
        if a.any():
            cross = (a.T @ b).astype(np.int64).astype(object)
            total += (cross + cross.T) * _HALF + (a.T @ a).astype(np.int64).astype(object) * _HALF**2
    return total


def _moments(rows: DataFrame, dimension: int) -> tuple[int, list[int], np.ndarray]:
    """The number of vectors, the sums of their entries, and of their products."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dimension, object), np.zeros((dimension,) * 2, object)
        for batch in batches:
            _, y = _whole(batch, dimension)
            n += len(y)
            first += y.astype(object).sum(axis=0) if len(y) else 0
            second += _scatter(y)
        upper = second[np.triu_indices(dimension)]
        values = [n, *first, *upper]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(values)), pa.int32()), pa.array([str(x) for x in values])], ["at", "value"]
        )

    found = rows.mapInArrow(sums, "at int, value string")
    # One number for each pair of dimensions.
    total = found.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    values = [0] * (1 + dimension + dimension * (dimension + 1) // 2)
    for row in total:
        values[row["at"]] = int(row["value"])
    second = np.zeros((dimension,) * 2, object)
    second[np.triu_indices(dimension)] = values[1 + dimension :]
    second = second + second.T - np.diag(np.diag(second))
    return values[0], values[1 : 1 + dimension], second


def _is_prime(n: int) -> bool:
    return all(n % i for i in range(3, isqrt(n) + 1, 2))


def primes_below(top: int, bits: int) -> list[int]:
    """Odd primes below ``top``, falling, until their product has more than ``bits`` bits."""
    found, product, n = [], 1, top - 1 | 1
    while product.bit_length() <= bits + 1:
        n -= 2
        if _is_prime(n):
            found.append(n)
            product *= n
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of a matrix's characteristic polynomial modulo a prime below 2**31."""
    h, size = matrix.astype(np.int64) % p, len(matrix)
    for j in range(size - 2):
        below = np.flatnonzero(h[j + 1 :, j])
        if not len(below):
            continue
        i = j + 1 + int(below[0])
        if i != j + 1:
            h[[i, j + 1]] = h[[j + 1, i]]
            h[:, [i, j + 1]] = h[:, [j + 1, i]]
        factors = h[j + 2 :, j] * pow(int(h[j + 1, j]), -1, p) % p
        h[j + 2 :] = (h[j + 2 :] - factors[:, None] * h[j + 1] % p) % p
        # The inverse column operations keep the matrix similar to the first.
        gains = (h[:, j + 2 :] * factors % p).sum(axis=1) % p
        h[:, j + 1] = (h[:, j + 1] + gains) % p
    minors = [np.array([1], np.int64)]
    for k in range(size):
        now = np.zeros(k + 2, np.int64)
        now[1:] = minors[k]
        now[:-1] = (now[:-1] - h[k, k] * minors[k]) % p
        run = 1
        for i in range(k - 1, -1, -1):
            run = run * int(h[i + 1, i]) % p
            if not run:
                break
            factor = run * int(h[i, k]) % p
            now[: i + 1] = (now[: i + 1] - factor * minors[i]) % p
        minors.append(now % p)
    return minors[-1].tolist()


def characteristic_polynomial(spark, matrix: np.ndarray) -> list[int]:
    """The exact coefficients, constant first, of ``det(x - matrix)`` of whole numbers."""
    size = len(matrix)
    # Each coefficient is a sum of minors, at most as large as the product of row lengths plus one.
    bound = 1
    for row in matrix:
        bound *= 1 + isqrt(sum(int(x) ** 2 for x in row) + 1)
    primes = primes_below(1 << 31, bound.bit_length() + 1)
    held = spark.sparkContext.broadcast([[int(x) for x in row] for row in matrix])

    def residues(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = np.array(held.value, object).reshape(size, size)
        for batch in batches:
            found = [polynomial_modulo((whole % p).astype(np.int64), p) for p in batch["p"].tolist()]
            yield pd.DataFrame({"p": batch["p"], "values": found})

    table = spark.createDataFrame([(p,) for p in primes], "p bigint")
    cores = spark.sparkContext.defaultParallelism
    table = table.repartition(max(1, min(cores, len(primes)))).mapInPandas(residues, "p bigint, values array<bigint>")
    value, modulus = [0] * (size + 1), 1
    for row in table.collect():  # as many as the coefficients have bits, over 31
        p = row["p"]
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((r - v) * inverse % p) for v, r in zip(value, row["values"])]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


def _beyond(poly: list[int], at: int, scale: int) -> int:
    """How many roots of a polynomial with real roots only are greater than ``at / 2**scale``."""
    # With x = (y + at) / 2**scale and the denominators cleared.
    size = len(poly) - 1
    moved = [c << scale * (size - i) for i, c in enumerate(poly)]
    for i in range(size):
        for j in range(size - 1, i - 1, -1):
            moved[j] += at * moved[j + 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign_at(poly: list[int], at: int, scale: int) -> int:
    value = 0
    for i, c in enumerate(reversed(poly)):
        value = value * at + (c << scale * i)
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], wanted: int) -> list[tuple[int, int]]:
    """``(root * 2**_BITS, how often)`` of the largest roots above 0 of a real-rooted polynomial, falling.

    Roots nearer to each other than 2**-64 of the largest count as one.
    """
    size = len(poly) - 1
    top = max(abs(c) for c in poly[:-1]).bit_length() + 1 if any(poly[:-1]) else 0
    counts: dict[tuple[int, int], int] = {}

    def beyond(at: int, scale: int) -> int:
        while scale and not at & 1:
            at, scale = at >> 1, scale - 1
        if (at, scale) not in counts:
            counts[at, scale] = _beyond(poly, at, scale)
        return counts[at, scale]

    positive = beyond(0, 0)
    if not positive:
        return []
    low, high = 0, top  # the least power of two beyond all roots
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if not beyond(1 << middle, 0) else (middle + 1, high)
    top = high
    close, narrow = max(0, 64 - top), max(0, _NARROW - top)
    found, open_ = [], [(0, 1 << top, 0, positive, 0)]  # (low, high], scale, roots above low, above high
    while open_ and sum(n for _, n in found) < wanted:
        low, high, scale, above_low, above_high = open_.pop()
        inside = above_low - above_high
        if inside == 1 or scale > close + 1:
            found.append((_narrowed(poly, low, high, scale, narrow, inside, beyond, above_high), inside))
            continue
        middle, scale = low + high, scale + 1
        above = beyond(middle, scale)
        for a, b, x, y in ((2 * low, middle, above_low, above), (middle, 2 * high, above, above_high)):
            if x > y:
                open_.append((a, b, scale, x, y))
    return found


def _narrowed(poly, low, high, scale, narrow, inside, beyond, above_high) -> int:
    """The middle of a root's interval, cut in halves until it is narrow enough."""
    if inside == 1:
        sign = _sign_at(poly, high, scale)
        if not sign:
            return high << _BITS - scale
        while scale < narrow:
            middle, scale = low + high, scale + 1
            here = _sign_at(poly, middle, scale)
            if not here:
                return middle << _BITS - scale
            low, high = (2 * low, middle) if here == sign else (middle, 2 * high)
    return (low + high) << _BITS - scale - 1


def _solver(matrix: np.ndarray, root: int):
    """Solves ``(matrix - root) x = b`` in fixed point, by elimination with pivots."""
    size, one = len(matrix), 1 << _BITS
    work = np.array([[int(x) << _BITS for x in row] for row in matrix], object)
    work[np.diag_indices(size)] -= root
    least, order, factors = 1, list(range(size)), []
    for j in range(size):
        i = j + max(range(size - j), key=lambda k: abs(work[j + k, j]))
        work[[i, j]] = work[[j, i]]
        order[i], order[j] = order[j], order[i]
        for row in factors:
            row[i], row[j] = row[j], row[i]
        # A pivot of 0 stands for one too small to be seen.
        work[j, j] = work[j, j] or least
        column = np.array([0] * (j + 1) + [(x << _BITS) // work[j, j] for x in work[j + 1 :, j]], object)
        factors.append(column)
        if j + 1 < size:
            work[j + 1 :, j:] -= column[j + 1 :, None] * work[j, j:] // one

    def solve(b: list[int]) -> np.ndarray:
        x = np.array([b[i] for i in order], object)
        for j in range(size):
            x[j + 1 :] -= factors[j][j + 1 :] * x[j] // one
        for j in range(size - 1, -1, -1):
            x[j] = (x[j] << _BITS) // work[j, j]
            x[:j] -= work[:j, j] * x[j] // one
        return x

    return solve


def _unit(x: np.ndarray) -> np.ndarray:
    """A vector of length 1 in fixed point."""
    longest = max(abs(int(v)) for v in x).bit_length()
    x = np.array([int(v) << 2 * _BITS >> longest for v in x], object)  # safe against lost digits
    length = isqrt(sum(int(v) ** 2 for v in x))
    return np.array([(int(v) << _BITS) // length for v in x], object)


def null_space(matrix: np.ndarray, root: int, times: int, rounds: int = 4) -> list[list[float]]:
    """``times`` orthonormal vectors of a root of that many, by inverse iteration."""
    size, one = len(matrix), 1 << _BITS
    solve = _solver(matrix, root)
    chosen = np.random.RandomState(7)
    basis = [_unit(np.array([int(x) for x in chosen.randint(-(1 << 30), 1 << 30, size)], object)) for _ in range(times)]
    for _ in range(rounds):
        done: list[np.ndarray] = []
        for vector in basis:
            vector = _unit(solve(list(vector)))
            for _ in range(2):
                for other in done:
                    vector = vector - other * (int((vector * other).sum()) >> _BITS) // one
                vector = _unit(vector)
            done.append(vector)
        basis = done
    return [[int(x) / one for x in vector] for vector in basis]


def components(spark, scatter: np.ndarray, roots: list[tuple[int, int]]) -> list[list[float]]:
    """The unit vectors of ``(root, how often)`` pairs, in their order."""
    held = spark.sparkContext.broadcast([[int(x) for x in row] for row in scatter])

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix = np.array(held.value, object)
        for batch in batches:
            found = [null_space(matrix, int(r), n) for r, n in zip(batch["root"], batch["times"])]
            yield pd.DataFrame({"at": batch["at"], "vectors": found})

    rows = [(i, str(root), times) for i, (root, times) in enumerate(roots)]
    table = spark.createDataFrame(rows, "at int, root string, times int").repartition(len(rows))
    table = table.mapInPandas(vectors, "at int, vectors array<array<double>>")
    # One vector for each component.
    return [v for row in sorted(table.collect(), key=lambda x: x["at"]) for v in row["vectors"]]


def _dimension(rows: DataFrame) -> int:
    sizes = rows.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).where("n > 0")
    most = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    return most["n"] if most else 0


def whitened_vectors(
    embeddings: DataFrame, most: int = 32, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(vec_id, n, deviation, values, explained, identity_error)``, a row for each usable vector.

    ``values`` are the whitened coordinates on the components with the
    largest variances, at most ``most`` and only those of a variance above 0;
    ``explained`` are their shares of the whole. ``deviation`` is NULL where it
    doesn't fit a long. Dropped are vectors that are NULL or hold NULLs, numbers
    that are not finite, or numbers beyond 2**34, and vectors of another length
    than most have (of lengths equally frequent the longest stays). Ids may be NULL or repeated; rows that repeat count
    each; other columns are ignored. Without vectors the result is empty; if
    all are equal there are no components.
    """
    spark = embeddings.sparkSession
    usable = F.col("vector").isNotNull() & ~F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > float(FAR // SCALE))
    )
    rows = embeddings.select(
        F.col(id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    ).where(usable)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n bigint, deviation bigint, values array<double>"
    dimension = _dimension(rows)
    n, first, second = _moments(rows, dimension) if dimension else (0, [], np.zeros((0, 0), object))
    if not n:
        empty = spark.createDataFrame([], f"{schema}, explained array<double>, identity_error double")
        return empty
    scatter = n * second - np.outer(np.array(first, object), np.array(first, object))
    total = int(np.trace(scatter))
    roots = largest_roots(characteristic_polynomial(spark, scatter), most) if total else []
    vectors = components(spark, scatter, roots) if roots else []
    values = [root for root, times in roots for _ in range(times)][:most]
    used = len(values)
    # The scatter is n ** 2 times the covariance.
    spreads = [float(isqrt(root << _BITS)) / 2.0**_BITS / n for root in values]
    axes = spark.sparkContext.broadcast(
        (np.array(vectors[:used], np.float64).reshape(used, dimension).T / np.array(spreads), first)
    )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        onto, sums = axes.value
        for batch in batches:
            kept, y = _whole(batch, dimension)
            biggest = max(int(np.abs(y).max(initial=0)) * n + max(abs(s) for s in sums), 1)
            if biggest**2 * dimension < 1 << 62:
                away = y * n - np.array(sums, np.int64)
                deviation = pa.array((away**2).sum(axis=1), pa.int64())
            else:
                away = y.astype(object) * n - np.array(sums, object)
                exact = [sum(int(v) ** 2 for v in row) for row in away]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            centred = (away / n).astype(np.float64).reshape(len(y), dimension)
            flat = (centred @ onto).reshape(-1)
            ends = np.arange(len(y) + 1, dtype=np.int32) * used
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept)), pa.array(np.full(len(y), n, np.int64)), deviation,
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float64())),
                ],
                ["vec_id", "n", "deviation", "values"],
            )

    table = materialize(rows.mapInArrow(project, schema), "whitened")
    error = _identity_error(table, n, used)
    shares = F.array(*[F.lit(float(root) / float(total << _BITS)) for root in values])
    return table.select("*", shares.cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"))


def _identity_error(table: DataFrame, n: int, used: int) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    if not used:
        return 0.0
    means = table.select(*[F.avg(F.get("values", F.lit(i))) for i in range(used)]).first()
    held = table.sparkSession.sparkContext.broadcast(np.array(means, np.float64))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((used, used))
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().reshape(-1, used) - held.value
            total += values.T @ values
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(used * used), pa.int32()), pa.array(total.reshape(-1))], ["at", "value"]
        )

    sums = table.select("values").mapInArrow(products, "at int, value double")
    sums = sums.groupBy("at").agg(F.sum("value").alias("value"))
    own = F.when(F.col("at") % (used + 1) == 0, 1.0).otherwise(0.0)
    return float(sums.agg(F.max(F.abs(F.col("value") / n - own))).first()[0])


def whiten(
    embeddings: DataFrame, most: int = 32, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``whitened_vectors`` with a row for each vector and component, numbered from 1."""
    table = whitened_vectors(embeddings, most, id, vector)
    table = table.select(
        "vec_id", "n", "deviation", "identity_error", "explained", F.posexplode("values").alias("_at", "whitened")
    )
    return table.select(
        "vec_id", (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get("explained", F.col("_at")).alias("explained"), "identity_error",
    )
