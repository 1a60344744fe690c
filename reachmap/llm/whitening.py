"""Whitening of embeddings: the leading components of a distributed covariance, and every row projected on them.

Each entry c becomes the whole number x = floor(64 c) + 1000000. Each distinct x-vector
once is the fit list. Its sums S and its covariance V (divisor n, centred before
multiplying) are gathered as one partial matrix a task. The eigenproblem of V, whose
size is that of a vector and does not grow with the table, is solved in steps:

* Householder reflections take V to a tridiagonal matrix T;
* Sturm counts (how many eigenvalues lie below a number) bisect the leading eigenvalues of T;
* inverse iteration gives the eigenvector of each, made orthogonal to those of its cluster;
* the reflections take them back to eigenvectors of V.

The components, 16 at most for each length of vectors, are broadcast, and every row,
copies included, is projected where it lies.

Defined cases: a null vector and one with a null or non-finite entry are left out;
vectors of other lengths are a space of their own with their own n, S and components;
vectors without entries have no components and so no rows; entries beyond +-1.4e17 count
as that (x is then still a long); a component without variance (copies of one vector
only, or fewer distinct vectors than components) has a null ``whitened`` and is left
out of ``identity_error``, which is 0 if none has variance; ``explained`` is 0 where the
trace is 0; a ``deviation`` that is no long is null; repeated ids and rows stay
repeated; an empty table gives no rows; further columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import written

#: Components at most, the scale and offset of x, and the largest scaled entry.
COMPONENTS, SCALE, OFFSET, LARGEST = 16, 64, 1_000_000, 9.2e18
#: Parts of the sums of one length that are added in one step.
FAN_IN = 64


# ---- the eigenproblem of one matrix ---------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and side diagonal of Q'aQ, and the Householder vectors whose reflections are Q: the k-th acts on the rows after k."""
    a, n, reflections = a.copy(), len(a), []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.abs(x[1:]).max()
        v = np.zeros_like(x)
        if size > 0:
            scale = np.abs(x).max()
            v = x / scale
            norm = np.linalg.norm(v)
            alpha = -norm if v[0] >= 0 else norm
            v[0] -= alpha
            v /= np.linalg.norm(v)
            part = a[k + 1 :, k + 1 :]
            p = part @ v
            w = 2 * (p - (p @ v) * v)
            part -= np.outer(v, w) + np.outer(w, v)
            a[k + 1, k], a[k + 2 :, k] = alpha * scale, 0
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, side2: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """Sturm counts: for each number how many eigenvalues are less. ``side2`` are the squares of the side diagonal, ``least`` what a pivot is at least."""
    q = diagonal[0] - at
    count = (q < 0).astype(int)
    for d, s in zip(diagonal[1:], side2, strict=True):
        q = np.where(np.abs(q) < least, -least, q)
        q = d - at - s / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, side: np.ndarray, m: int) -> np.ndarray:
    """The m greatest eigenvalues, falling, by bisection of the Gershgorin interval to the last bits."""
    n, pad = len(diagonal), np.abs(np.concatenate([[0], side, [0]]))
    reach = pad[:-1] + pad[1:]
    norm = max(float(np.abs(diagonal).max() + reach.max()), np.finfo(float).tiny)
    least = np.finfo(float).tiny + norm * np.finfo(float).eps ** 2
    low = np.full(m, (diagonal - reach).min() - norm * 1e-15)
    high = np.full(m, (diagonal + reach).max() + norm * 1e-15)
    rank = n - np.arange(m)  # the k-th greatest has n - k eigenvalues that are not greater
    for _ in range(130):
        middle = (low + high) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        short = below(diagonal, side**2, middle, least) < rank
        low, high = np.where(short, middle, low), np.where(short, high, middle)
    return (low + high) / 2


def solve_shifted(diagonal: np.ndarray, side: np.ndarray, shift: float, rows: np.ndarray, least: float) -> np.ndarray:
    """(T - shift)^-1 rows, by elimination with row exchanges; pivots near zero become ``least``."""
    n = len(diagonal)
    main, up, up2, y = (diagonal - shift).tolist(), [*side.tolist(), 0.0], [0.0] * n, rows.tolist()
    for i in range(n - 1):
        lower = float(side[i])
        if abs(main[i]) >= abs(lower):
            if abs(main[i]) < least:
                main[i] = least
            f = lower / main[i]
            main[i + 1] -= f * up[i]
            y[i + 1] -= f * y[i]
        else:
            f = main[i] / lower
            main[i], up[i], main[i + 1], up2[i], carried = lower, main[i + 1], up[i] - f * main[i + 1], up[i + 1], up[i + 1]
            up[i + 1] = -f * carried
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        rest = y[i] - (up[i] * y[i + 1] if i + 1 < n else 0.0) - (up2[i] * y[i + 2] if i + 2 < n else 0.0)
        y[i] = rest / main[i]
        if abs(y[i]) > 1e200:  # only the direction counts
            y = [t * 1e-200 for t in y]
    return np.array(y)


def leading_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of T as rows, one for each value (falling). Values closer than 1e-3 of the norm are a cluster, in which every step is followed by orthogonalisation."""
    n = len(diagonal)
    norm = float(np.abs(diagonal).max() + 2 * (np.abs(side).max() if n > 1 else 0)) or 1.0
    least, found, first = norm * np.finfo(float).eps, np.zeros((len(values), n)), 0
    random = np.random.default_rng(13)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * norm:
            first = k
        others = found[first:k]
        y = random.standard_normal(n)
        for _ in range(5):
            y = y / np.linalg.norm(y)
            y = solve_shifted(diagonal, side, value, y, least)
            y = y / np.abs(y).max()
            for _ in range(2):
                y = y - others.T @ (others @ y)
        found[k] = y / np.linalg.norm(y)
    return found


def leading_components(v: np.ndarray, m: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of a symmetric matrix, the m greatest at most, falling."""
    m = min(m, len(v))
    scale = float(np.abs(v).max()) or 1.0
    diagonal, side, reflections = tridiagonal(v / scale)
    values = leading_values(diagonal, side, m)
    vectors = leading_vectors(diagonal, side, values)
    for k in range(len(reflections) - 1, -1, -1):
        u = reflections[k]
        vectors[:, k + 1 :] -= 2 * np.outer(vectors[:, k + 1 :] @ u, u)
    return values * scale, vectors


# ---- the table ------------------------------------------------------------------------------


@dataclass
class Space:
    """What is fitted for one length of vectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole part and rest of the mean: x - whole is exact, and so is the small rest."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole), np.array([(s - self.n * w) / self.n for s, w in zip(self.sums, whole, strict=True)])

    @property
    def varies(self) -> np.ndarray:
        """Which components have variance beyond rounding."""
        return self.values > self.trace * len(self.sums) * np.finfo(float).eps


def quantised(vector: Column) -> Column:
    """The x-vector."""
    whole = lambda c: F.floor(F.least(F.greatest(c.cast("double") * F.lit(float(SCALE)), F.lit(-LARGEST)), F.lit(LARGEST)))
    return F.transform(vector, lambda c: whole(c) + F.lit(OFFSET).cast("long"))


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def _matrices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, dict[int, tuple[np.ndarray, np.ndarray]]]]:
    """Each batch, and for each length of its vectors their places and the matrix of them."""
    for batch in batches:
        x = batch.column(column)
        ends, values = x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(ends)
        yield batch, {int(d): (at := np.flatnonzero(sizes == d), values[ends[at][:, None] + np.arange(d)]) for d in np.unique(sizes) if d}


def _exact_sums(x: np.ndarray) -> list[int]:
    most = max(abs(int(x.max())), abs(int(x.min())))
    return [int(s) for s in (x.sum(axis=0) if most * len(x) < 1 << 62 else x.astype(object).sum(axis=0))]


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """For each length: how many distinct vectors there are, and their exact sums. One row a task and length, added up before the driver sees it."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for _, spaces in _matrices(batches, 0):
            for d, (_, x) in spaces.items():
                n, sums = held.get(d, (0, [0] * d))
                held[d] = (n + len(x), [a + b for a, b in zip(sums, _exact_sums(x), strict=True)])
        yield from _sum_rows(held)

    def added(table: pa.Table) -> pa.Table:
        d, n, sums = table["d"][0].as_py(), 0, None
        for k, s in zip(table["n"].to_pylist(), table["sums"].to_pylist(), strict=True):
            n, sums = n + k, [int(x) for x in s] if sums is None else [a + int(b) for a, b in zip(sums, s, strict=True)]
        return pa.Table.from_batches(_sum_rows({d: (n, sums)}))

    schema = "d int, n long, sums array<decimal(38,0)>"
    parts = fit.select("x").mapInArrow(part, schema)
    some = parts.withColumn("some", F.spark_partition_id() % FAN_IN).groupBy("d", "some").applyInArrow(added, schema)
    return {r.d: (r.n, [int(s) for s in r.sums]) for r in some.groupBy("d").applyInArrow(added, schema).toLocalIterator()}


def _sum_rows(held: dict[int, tuple[int, list[int]]]) -> list[pa.RecordBatch]:
    kind = pa.list_(pa.decimal128(38, 0))
    return [pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([[Decimal(s) for s in sums]], kind)], ["d", "n", "sums"]) for d, (n, sums) in held.items()]


def _products(rows: DataFrame, centred) -> dict[int, np.ndarray]:
    """For each length the sum of outer products of ``centred(d, x)``, a function of a matrix of x-vectors.

    A task gives the rows of one matrix for each length; equal rows of the matrices of
    all tasks are added in groups, so no task holds more than its share of them.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, spaces in _matrices(batches, 0):
            for d, (_, x) in spaces.items():
                c = centred(d, x)
                held[d] = held[d] + c.T @ c if d in held else c.T @ c
        for d, m in held.items():
            k = len(m)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, k * k + 1, k) if k else [0], pa.int32()), pa.array(m.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([d] * k, pa.int32()), pa.array(np.arange(k), pa.int32()), flat], ["d", "i", "row"])

    def added(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        total = np.sum(table["row"].combine_chunks().values.to_numpy().reshape(table.num_rows, -1), axis=0)
        return pa.table({"d": table["d"][:1], "i": table["i"][:1], "row": pa.array([total], pa.list_(pa.float64()))})

    schema = "d int, i int, row array<double>"
    out: dict[int, dict[int, list[float]]] = {}
    for r in rows.select("x").mapInArrow(part, schema).groupBy("d", "i").applyInArrow(added, schema).toLocalIterator():
        out.setdefault(r.d, {})[r.i] = r.row
    return {d: np.array([m[i] for i in sorted(m)]) for d, m in out.items()}


def _apart(x: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """x - whole, exact: as Python numbers where a long would not do."""
    small = max(abs(int(x.max())), abs(int(x.min())), int(np.abs(whole).max())) < 1 << 61
    return x - whole if small else x.astype(object) - whole.astype(object)


def _centred(x: np.ndarray, space: Space) -> np.ndarray:
    whole, rest = space.centre
    return _apart(x, whole).astype(float) - rest


def _whitened(x: np.ndarray, space: Space) -> np.ndarray:
    """(row, component); components without variance are NaN."""
    scale = np.sqrt(np.where(space.varies, space.values, np.nan))
    return _centred(x, space) @ space.components.T / scale


def fit(x_rows: DataFrame, most: int = COMPONENTS) -> dict[int, Space]:
    """The space of each length of the x-vectors in column ``x``; what the driver holds grows with lengths, not with rows."""
    listed = written(x_rows.select("x").distinct(), "fit-list")
    spark = x_rows.sparkSession
    spaces = {d: Space(n, sums, np.empty(0), np.empty((0, d)), 0.0) for d, (n, sums) in _sums(listed).items()}
    held = spark.sparkContext.broadcast(spaces)
    for d, m in _products(listed, lambda d, x: _centred(x, held.value[d])).items():
        v, space = m / spaces[d].n, spaces[d]
        space.trace = float(np.trace(v))
        space.values, space.components = leading_components((v + v.T) / 2, most)
    solved = spark.sparkContext.broadcast(spaces)

    def flat(d: int, x: np.ndarray) -> np.ndarray:
        space = solved.value[d]
        w = _whitened(x, space)[:, space.varies]
        # the mean of the whitened fit list is zero but for rounding; a column of ones gathers it, so that it is taken out exactly
        return np.column_stack([w, np.ones(len(w))])

    for d, m in _products(listed, flat).items():
        n, mean = spaces[d].n, m[-1, :-1] / spaces[d].n
        covariance = m[:-1, :-1] / n - np.outer(mean, mean)
        spaces[d].identity_error = float(np.abs(covariance - np.eye(len(covariance))).max()) if covariance.size else 0.0
    return spaces


def _deviations(x: np.ndarray, space: Space) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 for each row, exact; None if it is no long."""
    whole, n = np.array([s // space.n for s in space.sums]), space.n
    rest = np.array([s % space.n for s in space.sums])  # n x - S = n (x - whole) - rest
    off = _apart(x, whole)
    most = (int(np.abs(off).max()) + 1) * n
    if off.dtype != object and most * most * x.shape[1] < 1 << 62:
        return ((off * n - rest) ** 2).sum(axis=1).tolist()
    exact = (x.astype(object) * n - np.array(space.sums, dtype=object)) ** 2
    return [s if s < 1 << 63 else None for s in exact.sum(axis=1).tolist()]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each row with a finite vector and each component."""
    spark = rows.sparkSession
    x_rows = rows.filter(finite(F.col(vector_col))).select(F.col(id_col).alias("id"), quantised(F.col(vector_col)).alias("x"))
    shared = spark.sparkContext.broadcast(fit(x_rows, most))
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, spaces in _matrices(batches, 1):
            for d, (at, x) in spaces.items():
                space = shared.value[d]
                k, r = len(space.values), len(x)
                share = np.maximum(space.values, 0) / space.trace if space.trace > 0 else np.zeros(k)
                again = pa.array(np.repeat(at, k))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(again), pa.array(np.tile(np.arange(1, k + 1), r), pa.int32()), pa.array(np.full(r * k, space.n)),
                    pa.array(_deviations(x, space), pa.int64()).take(pa.array(np.repeat(np.arange(r), k))),
                    pa.array(_whitened(x, space).ravel(), from_pandas=True), pa.array(np.tile(share, r)), pa.array(np.full(r * k, space.identity_error)),
                ], names)

    kind = dict(rows.dtypes)[id_col]
    return x_rows.mapInArrow(project, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
