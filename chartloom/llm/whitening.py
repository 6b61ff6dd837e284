"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers x = floor(64 * c) + 1,000,000. The covariance V is that of the distinct x vectors (the fit list), and it is
exact: tasks sum products of entries centred at a whole number near the mean, in integers, and the rest of the centring is done in
integers too, before the one rounding to double.

Eigenpairs of V, a matrix of the vectors' dimension, are found from the top by slicing the spectrum. The LDL' factorisation of V - s*I
(symmetric pivoting, blocks of one and two) has as many positive pivots as V has eigenvalues above s, so bisection on counts encloses
the k-th largest eigenvalue in an interval without another one. Rayleigh quotient iteration, started by inverse iteration from the
interval's middle and kept orthogonal to the vectors found before, converges cubically; it is taken back to bisection whenever its
quotient leaves the interval. Counts on both sides of the result certify its number. Eigenvalues that agree to rounding share an
interval; their vectors are an orthonormal basis of the common space.

What reaches the driver is one number per pair of dimensions, whatever the number of rows; products are added by a shuffle.

Defined cases: rows with a NULL vector, or a NULL, NaN or infinite entry, are dropped; so are vectors whose length is not the table's
most frequent one (the longer of equally frequent ones), as their entries are missing; empty vectors are dropped. floor(64 * c) is held
to +-2**52. Components whose eigenvalue is zero to rounding cannot be whitened and are left out, so a fit list of one vector, an empty
table or constant vectors give no rows. Sums of squares beyond a long are NULL. NULL and repeated ids are rows like others; other
columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import quoted, scan, written

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LIMIT = 1 << 52
EPS = np.finfo(float).eps


# ---- spectrum slicing ------------------------------------------------------------------------------------------------------------


def inertia(a: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix are positive, and how many negative: the signs of its LDL' pivots."""
    a, up, down = np.array(a, float), 0, 0
    alpha = (1 + np.sqrt(17)) / 8
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, c = divmod(int(off.argmax()), len(a))
        if max(diagonal[p], off[r, c]) == 0:
            break
        if diagonal[p] >= alpha * off[r, c]:
            keep = np.arange(len(a)) != p
            pivot, column = a[p, p], a[keep, p]
            up, down = up + (pivot > 0), down + (pivot < 0)
            a = a[np.ix_(keep, keep)] - np.outer(column, column / pivot)
        else:  # a block of two with a large entry off its diagonal: one eigenvalue of each sign
            keep = np.ones(len(a), bool)
            keep[[r, c]] = False
            block, columns = a[np.ix_([r, c], [r, c])], a[np.ix_(keep, [r, c])]
            up, down = up + 1, down + 1
            a = a[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
        a = (a + a.T) / 2
    return up, down


def above(v: np.ndarray, s: float) -> int:
    return inertia(v - s * np.eye(len(v)))[0]


def _solve(v: np.ndarray, shift: float, rhs: np.ndarray, tiny: float) -> np.ndarray:
    for k in range(8):
        try:
            z = np.linalg.solve(v - (shift + k * tiny) * np.eye(len(v)), rhs)
            if np.isfinite(z).all():
                return z
        except np.linalg.LinAlgError:
            pass
    raise ArithmeticError("no shift near the eigenvalue gives a regular matrix")


def _apart(z: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Unit vector, orthogonal to those found (twice, against rounding)."""
    for _ in range(2):
        for u in found:
            z = z - (u @ z) * u
    return z / np.linalg.norm(z)


@dataclass
class Spectrum:
    values: np.ndarray
    vectors: np.ndarray  # one column per value
    certified: bool  # counts on both sides of every value agree with its number


def leading(v: np.ndarray, k: int) -> Spectrum:
    """The ``k`` largest eigenpairs that are not zero to rounding, by slicing."""
    size, trace = len(v), float(np.trace(v))
    if size == 0 or not trace > 0:
        return Spectrum(np.zeros(0), np.zeros((size, 0)), True)
    unit = float(np.abs(v).max())
    v = v / unit
    radius = np.abs(v).sum(axis=1) - np.abs(np.diag(v))
    top, floor = float((np.diag(v) + radius).max()) * (1 + 4 * EPS), 64 * size * EPS * float(np.trace(v))
    width = 8 * size * EPS * top
    counts: dict[float, int] = {top: 0}

    def count(s: float) -> int:
        if s not in counts:
            counts[s] = above(v, s)
        return counts[s]

    k = min(k, count(floor))
    values, vectors, certified = [], [], True
    for number in range(1, k + 1):
        low = max((s for s in counts if counts[s] >= number), default=floor)
        high = min(s for s in counts if counts[s] < number and s > low)
        # alone in its interval, or as narrow as rounding allows: a group of equal eigenvalues
        while high - low > width and (count(low) != number or count(high) != number - 1):
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= number else (low, middle)
        start = np.cos(np.arange(1.0, size + 1) * (number + 0.5))  # no symmetry that an eigenvector could be orthogonal to
        z = _apart(start, vectors)
        rho = (low + high) / 2
        for _ in range(3):
            z = _apart(_solve(v, rho, z, width), vectors)
        best = np.inf
        for _ in range(200):
            rho = float(z @ v @ z)
            residual = float(np.linalg.norm(v @ z - rho * z))
            inside = low - width <= rho <= high + width
            if inside and residual >= best / 2 and residual <= 64 * size * EPS * top:
                break
            best = min(best, residual) if inside else np.inf
            if not inside:  # the quotient follows another eigenvalue: halve the interval instead
                if high - low > width:
                    middle = (low + high) / 2
                    low, high = (middle, high) if count(middle) >= number else (low, middle)
                rho = (low + high) / 2
            z = _apart(_solve(v, rho, z, width), vectors)
        slack = max(width, 4 * residual)
        certified &= count(rho + slack) < number <= count(rho - slack)
        values.append(rho)
        vectors.append(z * (1 if z[np.abs(z).argmax()] > 0 else -1))
    order = sorted(range(k), key=lambda i: -values[i])
    columns = np.array([vectors[i] for i in order]).T if k else np.zeros((size, 0))
    return Spectrum(np.array([values[i] * unit for i in order]), columns, bool(certified))


# ---- exact sums ------------------------------------------------------------------------------------------------------------------


def whole(vector: Column) -> Column:
    entry = lambda c: F.greatest(F.least(F.floor(c * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)) + SHIFT
    return F.transform(vector, entry)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with finite entries and the most frequent length: id and x."""
    v = quoted(vector_col).cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = rows.filter(v.isNotNull() & (F.size(v) > 0) & finite)
    sizes = kept.groupBy(F.size(v).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return kept.filter(F.size(v) == (sizes["size"] if sizes else 0)).select(quoted(id_col).alias("id"), whole(v).alias("x"))


def matrix_of(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    col = batch.column(column)
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _integers(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def _gram(d: np.ndarray) -> np.ndarray:
    """Exact products of integer columns: in blocks that double arithmetic holds exactly, else in Python integers."""
    most = int(np.abs(d).max(initial=0))
    if most < 1 << 25:
        rows = max(1, (1 << 53) // max(1, most * most))
        parts = [d[a : a + rows].astype(float) for a in range(0, len(d), rows)]
        return sum((p.T @ p).astype(np.int64).astype(object) for p in parts)
    o = d.astype(object)
    return o.T @ o


@dataclass
class Fit:
    n: int
    sums: list[int]
    covariance: np.ndarray
    trace: float
    spectrum: Spectrum


def moments(points: DataFrame) -> tuple[int, list[int], list[list[int]], list[int]]:
    """Number of rows, sums per dimension, exact products of entries centred at whole numbers, and these numbers."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                x = matrix_of(batch)
                high, low = (x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)
                part = high.astype(object) * (1 << 26) + low.astype(object)
                n, total = n + len(x), part if total is None else total + part
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()), _integers(total)], names=["i", "n", "s"])

    found = scan(points, sums, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s")).orderBy("i").collect()
    if not found:
        return 0, [], [], []
    n, total = found[0]["n"], [int(r["s"]) for r in found]
    centre = [(2 * s + n) // (2 * n) for s in total]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, gram = np.array(centre, np.int64), None
        for batch in batches:
            if batch.num_rows:
                part = _gram(matrix_of(batch) - c)
                gram = part if gram is None else gram + part
        if gram is not None:
            for i in range(len(gram)):
                j = np.arange(i, len(gram))
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(j), pa.int32()), pa.array(j, pa.int32()), _integers(gram[i, i:])], names=["i", "j", "g"])

    cells = scan(points, products, "i int, j int, g decimal(38,0)").groupBy("i", "j").agg(F.sum("g").cast("decimal(38,0)").alias("g"))
    gram = [[0] * len(total) for _ in total]
    for r in cells.collect():  # one cell per pair of dimensions
        gram[r["i"]][r["j"]] = gram[r["j"]][r["i"]] = int(r["g"])
    return n, total, gram, centre


def fit(points: DataFrame, components: int = COMPONENTS) -> Fit:
    """Covariance and leading eigenpairs of distinct points (a column ``x`` of whole numbers)."""
    n, sums, gram, centre = moments(points)
    size = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    exact = [[n * gram[i][j] - rest[i] * rest[j] for j in range(size)] for i in range(size)]
    square = n * n
    covariance = np.array([[e / square for e in row] for row in exact], float).reshape(size, size)
    trace = sum(exact[i][i] for i in range(size)) / square if n else 0.0
    return Fit(n, sums, covariance, trace, leading(covariance, components))


def _projection(model: Fit):
    """Whitened components of rows of whole numbers, and n * x - S of them."""
    scaled = model.spectrum.vectors / np.sqrt(model.spectrum.values)[None, :]
    n, sums = model.n, model.sums
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def apply(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        c, rest = np.array(centre, np.int64), [n * c - s for c, s in zip(centre, sums, strict=True)]
        d = x - c
        if int(np.abs(d).max(initial=0)) * n + max(map(abs, rest), default=0) < 1 << 62:
            y = d * n + np.array(rest, np.int64)
        else:
            y = d.astype(object) * n + np.array(rest, object)
        return (y / n).astype(float) @ scaled, y

    return apply


def _squares(y: np.ndarray) -> list[int | None]:
    most = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0)))) if y.size else 0
    if most * most * max(1, y.shape[1]) < 1 << 63:
        return (y.astype(np.int64) ** 2).sum(axis=1).tolist()
    o = y.astype(object)
    return [t if t < 1 << 63 else None for t in (o * o).sum(axis=1).tolist()]


def identity_error(points: DataFrame, model: Fit) -> float:
    """Largest entry by which the whitened fit list's covariance differs from the identity, measured on the fit list."""
    apply, k = _projection(model), len(model.spectrum.values)

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = apply(matrix_of(batch))[0]
                total, products = total + w.sum(axis=0), products + w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[i, np.full(k, -1)], pa.int32()), pa.array(np.r_[j, np.arange(k)], pa.int32()), pa.array(np.r_[products[i, j], total])], names=["i", "j", "v"]
        )

    found = {(r["i"], r["j"]): r["v"] for r in scan(points, per_task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    mean = [found[-1, j] / model.n for j in range(k)]
    return max(abs(found[i, j] / model.n - mean[i] * mean[j] - (i == j)) for i in range(k) for j in range(i, k))


OUTPUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: id, component, n, deviation, whitened, explained, identity_error."""
    x = usable(rows, id_col, vector_col)
    points = written(x.select("x").distinct(), "whitening-points")
    model = fit(points, components)
    k = len(model.spectrum.values)
    schema = f"id {rows.schema[id_col].dataType.simpleString()}, {OUTPUT}"
    if k == 0:
        return rows.sparkSession.createDataFrame([], schema)
    if not model.spectrum.certified:
        raise ArithmeticError("the counts do not certify the numbering of the eigenvalues")
    error, apply, n = identity_error(points, model), _projection(model), model.n
    explained = model.spectrum.values / model.trace

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if m:
                w, y = apply(matrix_of(batch))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                     pa.array([s for s in _squares(y) for _ in range(k)], pa.int64()), pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["id", *(c.split()[0] for c in OUTPUT.split(", "))],
                )

    return scan(x, per_task, schema)
