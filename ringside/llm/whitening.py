"""Operator 11: whitening of embeddings by spectrum slicing.

1. Counts: every vector becomes whole numbers, so count and sums per dimension are
   exact (64-bit halves per batch, Python integers in the end).
2. Covariance: vectors are centred at the exact mean before they are multiplied; each
   task sends one matrix, and matrices are added in groups before the driver adds the
   last few. What reaches the driver is bounded by the dimensions, not by the rows.
3. Spectrum: the covariance is brought to tridiagonal form by reflections, which keeps
   the inertia of every shifted covariance. The signs of D in the LDL' factorisation of
   the shifted matrix count the eigenvalues above a shift. Halving an interval by these
   counts isolates each leading eigenvalue, Rayleigh quotient iteration on the
   covariance itself converges from there, and counts on both sides of the result
   certify its number.
4. Projection: rows are centred, projected and scaled; the covariance of the projected
   rows is measured over all of them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringside.llm.common import table

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: A component that holds no larger part of the trace is rounding, not spread, and is left out.
NOISE = 1e-12
#: Matrices are added in so many groups, then in so many, then on the driver.
LANES, LAST_LANES = 64, 4
_LOW = (1 << 32) - 1
_LONG = 1 << 63


# -- spectrum ---------------------------------------------------------------

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a matrix with the eigenvalues of v, by reflections from both sides."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if not norm:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        p = 2 * (a[k + 1:, k + 1:] @ x)
        p -= (x @ p) * x
        a[k + 1:, k + 1:] -= np.outer(x, p) + np.outer(p, x)
        a[k, k + 1:] = a[k + 1:, k] = 0
        a[k, k + 1] = a[k + 1, k] = -np.copysign(norm, x[0])
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy()


def above(diagonal: np.ndarray, off: np.ndarray, shift: float) -> int:
    """Number of eigenvalues greater than the shift: positive entries of D in LDL' of the shifted tridiagonal matrix."""
    count, d = 0, 1.0
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    squares = np.concatenate(([0.0], off * off)).tolist()
    for a, b in zip((diagonal - shift).tolist(), squares):
        d = a - b / d
        if abs(d) < tiny:
            d = -tiny
        count += d > 0
    return count


def leading(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as rows; those within NOISE of the trace are left out.

    Raises ArithmeticError where the counts do not certify a result.
    """
    v = (v + v.T) / 2
    n, trace = len(v), float(np.trace(v)) if len(v) else 0.0
    if not trace > 0:
        return np.zeros(0), np.zeros((0, n))
    diagonal, off = tridiagonal(v)
    reach = np.abs(np.concatenate((off, [0.0]))) + np.abs(np.concatenate(([0.0], off)))
    top, bottom = float((diagonal + reach).max()), float((diagonal - reach).min())
    size = max(abs(top), abs(bottom))
    fuzz = 8 * n * np.finfo(float).eps * size
    noise = max(NOISE * trace, 4 * fuzz)
    values, vectors = [], np.zeros((0, n))
    rng = np.random.default_rng(n)
    for k in range(1, min(most, n) + 1):
        low, high = bottom - fuzz, (values[-1] if values else top) + fuzz
        if above(diagonal, off, noise) < k:
            break
        found = None
        while found is None:
            middle = (low + high) / 2
            alone = above(diagonal, off, low) == k and above(diagonal, off, high) == k - 1
            if (alone or high - low <= fuzz) and high - low <= max(fuzz, 0.25 * (abs(middle) + fuzz)):
                found = _rayleigh(v, vectors, low, high, rng, fuzz)
            if found is None:
                if high - low <= fuzz / 4:
                    raise ArithmeticError(f"no vector found for component {k}")
                if above(diagonal, off, middle) >= k:
                    low = middle
                else:
                    high = middle
        value, vector = found
        if not above(diagonal, off, value + fuzz) < k <= above(diagonal, off, value - fuzz):
            raise ArithmeticError(f"the counts do not certify component {k}")
        if value <= noise:
            break
        values.append(value)
        vectors = np.concatenate((vectors, vector[None]))
    return np.array(values), vectors


def _rayleigh(v, known, low, high, rng, fuzz):
    """An eigenvalue in [low, high] and its vector, apart from the known vectors; None where the iteration leaves it."""
    eye = np.eye(len(v))

    def apart(x):
        for _ in range(2):
            x = x - known.T @ (known @ x)
        return x / np.linalg.norm(x)

    x, shift, best = apart(rng.normal(size=len(v))), (low + high) / 2, np.inf
    for turn in range(40):
        try:
            x = apart(np.linalg.solve(v - shift * eye, x))
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            shift += fuzz / 64
            continue
        value = float(x @ (v @ x))
        rest = float(np.linalg.norm(v @ x - value * x))
        if not low - fuzz <= value <= high + fuzz and turn > 2:
            return None
        if rest <= fuzz and rest >= best / 2:
            return value, x
        best = min(best, rest)
        if turn >= 2:  # from the third on the quotient itself, when the vector leans to this eigenvalue
            shift = value
    return None


# -- statistics -------------------------------------------------------------

def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(id, x) of the rows that take part, and the dimension: x = floor(1024 * c) + 100000 per entry, as longs.

    A vector that is null, holds null or non-finite entries or an entry whose x leaves 64 bits is dropped. The dimension
    is that of the longest; shorter vectors lack entries and are dropped as if these were null. So is an empty one.
    """
    wide = F.col(f"`{vector}`").cast("array<double>")
    limit = float(1 << 62)  # as a double the product is whole there already
    fine = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e * SCALE) < limit)
    held = rows.select(F.col(f"`{id_col}`").alias("id"), wide.alias("x")).filter(
        F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", fine))
    dims = held.agg(F.max(F.size("x"))).first()[0] or 0
    x = F.transform("x", lambda e: F.floor(e * SCALE).cast("bigint") + OFFSET)
    return held.filter(F.size("x") == dims).select("id", x.alias("x")), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension."""
    def of(batches):
        n, high, low = 0, [0] * dims, [0] * dims
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), dims)
                n += len(x)
                high = [a + b for a, b in zip(high, (x >> 32).sum(0).tolist())]
                low = [a + b for a, b in zip(low, (x & _LOW).sum(0).tolist())]
        yield pa.RecordBatch.from_pydict({"n": [n] * dims, "at": pa.array(range(dims), pa.int32()), "high": list(map(str, high)),
                                          "low": list(map(str, low))})

    parts = vectors.select("x").mapInArrow(of, "n bigint, at int, high string, low string")
    number = "decimal(38,0)"
    total = parts.groupBy("at").agg(F.sum("n"), F.sum(F.col("high").cast(number)), F.sum(F.col("low").cast(number))).collect()
    total.sort()
    return (int(total[0][1]), [(int(r[2]) << 32) + int(r[3]) for r in total]) if total else (0, [])


def _added(matrices: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of the matrices (lane, m): in lanes, then fewer lanes, then here."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(m) for m in rows.sort_values("m")["m"])
        return pd.DataFrame({"lane": rows["lane"].iloc[:1], "m": [total.tobytes()]})

    for lanes in (LANES, LAST_LANES):
        matrices = matrices.withColumn("lane", F.col("lane") % lanes).groupBy("lane").applyInPandas(add, "lane int, m binary")
    parts = [r["m"] for r in matrices.orderBy("lane").collect()]
    return sum((np.frombuffer(m) for m in parts), np.zeros(int(np.prod(shape)))).reshape(shape)


def _centred(x: np.ndarray, n: int, s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S: as doubles, and exact, as longs where they fit, else as Python integers."""
    top = max(1, int(np.abs(x).max(initial=0)))
    if n * top < 1 << 52 and max(map(abs, s), default=0) < 1 << 52:
        exact = n * x - np.array(s, np.int64)
    else:
        exact = n * x.astype(object) - np.array(s, object)
    return exact.astype(np.float64), exact


def covariance(vectors: DataFrame, n: int, s: list[int]) -> np.ndarray:
    """Covariance, divisor n, of rows that are centred before multiplying."""
    dims = len(s)

    def of(batches):
        from pyspark import TaskContext

        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                c = _centred(_matrix(batch.column(0), dims), n, s)[0] / n
                total += c.T @ c
        yield pa.RecordBatch.from_pydict({"lane": pa.array([TaskContext.get().partitionId()], pa.int32()), "m": [total.tobytes()]})

    return _added(vectors.select("x").mapInArrow(of, "lane int, m binary"), (dims, dims)) / n


def _projected(x: np.ndarray, n: int, s: list[int], axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide, exact = _centred(x, n, s)
    return wide / n @ axes.T, exact


def _squares(exact: np.ndarray) -> list[int | None]:
    """Sum of squares of every row, exact; None where it leaves 64 bits."""
    if exact.dtype != object and int(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < _LONG:
        return (exact * exact).sum(1).tolist()
    totals = [sum(v * v for v in map(int, row)) for row in exact]
    return [t if t < _LONG else None for t in totals]


def identity_error(vectors: DataFrame, n: int, s: list[int], axes: np.ndarray) -> float:
    """Largest absolute entry of the projected rows' covariance minus the identity."""
    k, dims = len(axes), len(s)

    def of(batches):
        from pyspark import TaskContext

        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = _projected(_matrix(batch.column(0), dims), n, s, axes)[0]
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        yield pa.RecordBatch.from_pydict({"lane": pa.array([TaskContext.get().partitionId()], pa.int32()), "m": [total.tobytes()]})

    total = _added(vectors.select("x").mapInArrow(of, "lane int, m binary"), (k + 1, k)) / n
    # the rows' mean is zero but for rounding, so taking it off afterwards loses nothing
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max(initial=0.0))


# -- operator ---------------------------------------------------------------

def whiten(rows: DataFrame, most: int = COMPONENTS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes part and component.

    Components are numbered from 1 by falling eigenvalue; there are fewer than `most` where the vectors have fewer
    dimensions or spread (one row or equal rows: none, and no rows are returned). Equal eigenvalues take any orthonormal
    vectors of their space. deviation is the sum over dimensions of (n * x - S) ** 2, null where it leaves 64 bits. Null
    and repeated ids are rows like others; repeated rows count as often as they come. See whole_vectors for what is
    dropped. Other columns play no part. An empty table gives an empty table.
    """
    kept = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    vectors, dims = whole_vectors(rows, id_col, vector)
    spark = rows.sparkSession
    n, s = sums(vectors, dims) if dims else (0, [])
    if not n:
        return spark.createDataFrame([], kept)
    v = covariance(vectors, n, s)
    values, axes = leading(v, most)
    if not len(values):
        return spark.createDataFrame([], kept)
    axes = axes / np.sqrt(values)[:, None]
    error = identity_error(vectors, n, s, axes)
    k, explained = len(values), values / np.trace(v)

    def of(batches):
        for batch in batches:
            w, exact = _projected(_matrix(batch.column(1), dims), n, s, axes)
            m = len(w)
            every = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(every)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(_squares(exact), pa.int64()).take(pa.array(every)), pa.array(w.ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(F.col("id").cast("bigint").alias("id"), "x").mapInArrow(of, kept)


def op11(spark, sf_dir):
    """The eight leading whitened components of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings"))


#: Eigenvectors to double precision are out of SQL's reach.
QUERIES = {"op11_spectrum_slicing_whitening": op11}
