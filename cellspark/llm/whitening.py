"""Whitening of vectors by leading eigenvectors of their covariance, found by contour integration (FEAST).

Vectors are put on a grid of whole numbers, and each distinct grid vector is fitted once. Sums and products of whole
numbers are exact, so the covariance does not depend on the order in which tasks add them up: vectors are centred by
the whole part of their mean before they are multiplied, and the rest of the mean, below one, is taken off exactly.

The spectrum is cut into intervals of few eigenvalues by counts of inertia: a matrix shifted by s has as many positive
eigenvalues as there are eigenvalues above s, and an orthogonal change to tridiagonal form keeps that number. Each
interval is one row of a Spark job: a quadrature of complex shifted solves on the circle around it projects a random
block onto its eigenspace, Rayleigh-Ritz extracts eigenpairs, and the two are repeated until the residuals no longer
matter. An interval whose number of converged pairs is not its count of inertia raises an error.

Bounds: a covariance of at most ``MOST_DIMENSIONS`` squared is collected and broadcast; no rows are.

Rows whose vector is null or holds null or non-finite entries are left out; a null key is a key like others, and
repeated rows each get their result. A vector shorter than the longest has zeros at its end. An entry beyond
``LARGEST`` in size counts as that. Directions without variance are not components: an empty table, or one whose
vectors are all the same, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellspark.functions.lineage import store

COMPONENTS = 16
SCALE = 64
MOST_DIMENSIONS = 2_048
LARGEST = float(1 << 34)
ROWS_AT_ONCE = 4_096

#: Eigenvalues an interval is split above, quadrature nodes on half a circle, rounds before giving up.
MOST_IN_INTERVAL, NODES, ROUNDS = 8, 8, 90
#: Residual and least eigenvalue, as parts of the largest eigenvalue.
CONVERGED, NO_VARIANCE = 1e-13, 1e-12


def grid(vector: str) -> Column:
    """Whole numbers of a vector's entries; null if the vector or an entry is null or not finite."""
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    whole = F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double")))))
    return F.when(inside, whole)


def _matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    """Lists of whole numbers as rows of ``dimensions`` numbers, zeros at the end of shorter ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(flat) == dimensions * len(sizes):
        return flat.reshape(len(sizes), dimensions)
    out = np.zeros((len(sizes), dimensions), np.int64)
    out[np.arange(dimensions) < sizes[:, None]] = flat
    return out


def _parts(batches: Iterable[pa.RecordBatch], name: str) -> Iterator[pa.ListArray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.column(name).slice(at, ROWS_AT_ONCE)


def _exact(matrix: np.ndarray, terms: int) -> np.ndarray:
    """The matrix in a type in which sums of ``terms`` products of its entries are exact."""
    size = int(np.abs(matrix).max(initial=0)) ** 2 * max(1, terms)
    return matrix.astype(np.float64) if size < 1 << 53 else matrix if size < 1 << 63 else matrix.astype(object)


def _decimals(values: list[int]) -> pa.Array:
    return pa.array(values, pa.decimal128(38, 0))


def _summed(fit: DataFrame, rows, names: list[str]) -> dict[tuple, int]:
    """Sums of ``rows(batches)`` -> (columns of whole numbers, amounts), by those columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *at, amounts = rows(batches)
        yield pa.RecordBatch.from_arrays([*[pa.array(a, pa.int32()) for a in at], _decimals([int(v) for v in amounts])], [*names, "amount"])

    sent = fit.mapInArrow(run, ", ".join(f"{c} int" for c in names) + ", amount decimal(38,0)")
    total = sent.groupBy(*names).agg(F.sum("amount").alias("amount")).toArrow()
    return dict(zip(zip(*[total.column(c).to_pylist() for c in names], strict=True), map(int, total.column("amount").to_pylist()), strict=True))


def _lengths(fit: DataFrame) -> tuple[int, int]:
    row = fit.agg(F.min(F.size("grid")), F.max(F.size("grid"))).first()
    return row[0] or 0, row[1] or 0


def fitted_rows(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(stored table of each distinct grid vector once, their length); ``vectors`` has a column grid."""
    fit = store(vectors.select("grid").where("grid IS NOT NULL").distinct())
    least, most = _lengths(fit)
    if least != most:
        fit = store(fit.select(F.concat("grid", F.array_repeat(F.lit(0).cast("bigint"), F.lit(most) - F.size("grid"))).alias("grid")).distinct())
    if most > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {most} entries, and covariances of more than {MOST_DIMENSIONS} are not collected")
    return fit, most


@dataclass
class Moments:
    """Number of fitted rows, exact sums of their entries, and covariance."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def base(self) -> np.ndarray:
        """Whole part of the mean."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what is left of the mean."""
        return [s % self.n for s in self.sums]


def moments(fit: DataFrame, dimensions: int) -> Moments:
    """Moments of the fitted rows; ``dimensions`` and the square of it bound what comes to the driver."""

    def sums(batches):
        total, n = np.zeros(dimensions, object), 0
        for part in _parts(batches, "grid"):
            rows = _matrix(part, dimensions)
            total = total + _exact(rows, len(rows)).sum(axis=0).astype(object)
            n += len(rows)
        return range(-1, dimensions), [n, *total]

    found = _summed(fit, sums, ["i"])
    n = found.get((-1,), 0)
    out = Moments(n, [found.get((i,), 0) for i in range(dimensions)], np.zeros((dimensions, dimensions)))
    if not n or not dimensions:
        return out
    base, upper = out.base, np.triu_indices(dimensions)

    def products(batches):
        total = np.zeros((dimensions, dimensions), object)
        held, terms = np.zeros((dimensions, dimensions)), 0
        for part in _parts(batches, "grid"):
            rows = _exact(_matrix(part, dimensions) - base, len(part))
            if rows.dtype == np.float64:
                step = rows.T @ rows
                if terms + int(step.max()) >= 1 << 53:  # the largest entry of a product of a matrix with itself is on its diagonal
                    total, held, terms = total + held.astype(np.int64), np.zeros_like(held), 0
                held, terms = held + step, terms + int(step.max())
            else:
                total = total + (rows.T @ rows).astype(object)
        return *[u.tolist() for u in upper], (total + held.astype(np.int64))[upper]

    found, rest = _summed(fit, products, ["i", "j"]), out.rest
    for (i, j), amount in found.items():
        out.covariance[i, j] = out.covariance[j, i] = (n * amount - rest[i] * rest[j]) / (n * n)
    return out


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(diagonal, squares of the entries beside it) of an orthogonally similar tridiagonal matrix."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        length = np.sqrt(v @ v)
        if length == 0:
            continue
        v[0] += length if v[0] >= 0 else -length
        v /= np.sqrt(v @ v)
        block = a[k + 1 :, k + 1 :]
        w = block @ v
        w -= (v @ w) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 2 :, k] = 0
        a[k + 1, k] = -length if v[0] >= 0 else length
    return np.diag(a).copy(), np.diag(a, -1) ** 2


def above(form: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """The number of eigenvalues above each shift: positive pivots of the shifted tridiagonal matrix."""
    diagonal, beside = form
    tiny = np.finfo(float).eps * (np.abs(diagonal).max(initial=0) + np.sqrt(beside.max(initial=0))) + np.finfo(float).tiny
    pivot = diagonal[0] - shifts
    pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
    count = (pivot > 0).astype(np.int64)
    for d, b in zip(diagonal[1:], beside, strict=True):
        pivot = d - shifts - b / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def located(form: tuple[np.ndarray, np.ndarray], most: int, bound: float) -> np.ndarray:
    """Where the ``most`` largest eigenvalues lie, falling, by halving brackets on counts of inertia."""
    rank = np.arange(1, most + 1)
    low, high = np.full(most, -bound), np.full(most, bound)
    for _ in range(50):
        middle = (low + high) / 2
        many = above(form, middle) >= rank
        low, high = np.where(many, middle, low), np.where(many, high, middle)
    return (low + high) / 2


def intervals(form: tuple[np.ndarray, np.ndarray], most: int, components: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between) from the top down, holding ``components`` eigenvalues that have variance.

    Groups of neighbours are cut at their widest gap until they have at most ``most`` members and the gaps around them
    are not small against their width, which the quadrature's filter needs to tell inside from outside. Members too
    close together to cut stay together, however many: the count of inertia says how many there are.
    """
    diagonal, beside = form
    size = len(diagonal)
    bound = float((np.abs(diagonal) + np.sqrt(np.append(beside, 0)) + np.sqrt(np.insert(beside, 0, 0))).max()) * (1 + 1e-9)
    if bound == 0:
        return []
    places = located(form, min(size, components + most + 1), bound)
    close = 1e-9 * bound
    usable = int((places > NO_VARIANCE * bound).sum())
    end = usable if usable < len(places) or usable == size else usable - 1
    below = np.append(places[:-1] - places[1:], places[-1] + bound)  # gap after each place
    waiting, done = [(0, end)], []
    while waiting:
        first, last = waiting.pop()
        if first >= min(components, end):
            continue
        around = min(below[last - 1], below[first - 1] if first else np.inf)
        width, inner = places[first] - places[last - 1], below[first : last - 1]
        if len(inner) and inner.max() > 4 * close and (last - first > most or around < width / 10):
            at = first + 1 + int(inner.argmax())
            waiting += [(at, last), (first, at)]
            continue
        pad = max(around / 2, close)
        low, high = max(places[last - 1] - pad, NO_VARIANCE * bound), places[first] + pad
        done.append((float(low), float(high), int(np.subtract(*above(form, np.array([low, high]))))))
    return done


def eigenpairs(matrix: np.ndarray, low: float, high: float, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the ``n`` eigenpairs between ``low`` and ``high``."""
    size, middle, radius = len(matrix), (low + high) / 2, (high - low) / 2
    scale = np.abs(matrix).sum(axis=0).max()
    points, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(0.5j * np.pi * (points + 1))
    rng = np.random.default_rng(7)
    block = rng.standard_normal((size, min(size, n + n // 2 + 4)))
    worst = np.inf
    for done in range(ROUNDS):
        if done % 6 == 5:  # slow where eigenvalues crowd outside: a wider block takes them in, at last all
            more = min(size, 2 * block.shape[1]) - block.shape[1]
            block, worst = np.hstack((block, rng.standard_normal((size, more)))), np.inf
        projected = np.zeros_like(block)
        for turn, weight in zip(turns, weights, strict=True):
            shifted = (middle + radius * turn) * np.eye(size) - matrix
            projected += 0.5 * weight * (radius * turn * np.linalg.solve(shifted, block.astype(complex))).real
        basis, _ = np.linalg.qr(projected)
        values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ inner
        inside = (values > low) & (values <= high)
        residual = np.sqrt(((matrix @ block - block * values) ** 2).sum(axis=0))[inside].max(initial=0)
        if inside.sum() == n and residual <= CONVERGED * scale and residual >= worst / 2:
            return values[inside], block[:, inside]
        worst = residual if inside.sum() == n else np.inf
    if worst <= CONVERGED * scale:
        return values[inside], block[:, inside]
    raise ArithmeticError(f"{inside.sum()} of {n} eigenvalues between {low} and {high} converged; residual {worst}")


def leading(spark, covariance: np.ndarray, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns), at most ``components`` and none without variance."""
    size = len(covariance)
    form = tridiagonal(covariance) if size else (np.zeros(0), np.zeros(0))
    found = intervals(form, MOST_IN_INTERVAL, components) if size else []
    if not found:
        return np.zeros(0), np.zeros((size, 0))
    sent = spark.sparkContext.broadcast(covariance)

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                values, vectors = eigenpairs(sent.value, r["low"], r["high"], r["n"])
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], ["value", "vector"])

    rows = spark.createDataFrame(found, "low double, high double, n int").repartition(len(found), "low")
    pairs = sorted(rows.mapInArrow(solve, "value double, vector array<double>").collect(), key=lambda r: -r["value"])
    if len(pairs) != sum(n for *_, n in found):
        raise ArithmeticError("eigenvalues were missed")
    pairs = pairs[:components]
    return np.array([r["value"] for r in pairs]), np.array([r["vector"] for r in pairs]).T


@dataclass
class Whitening:
    """A fitted whitening: moments, eigenvalues, eigenvectors as columns."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray

    def __post_init__(self):
        self.base, self.rest = self.moments.base, np.array(self.moments.rest, np.float64) / max(1, self.moments.n)
        self.projection = self.vectors / np.sqrt(self.values)

    def whiten(self, part: pa.ListArray) -> np.ndarray:
        return (_matrix(part, len(self.base)) - self.base - self.rest) @ self.projection

    def deviations(self, part: pa.ListArray) -> list[int]:
        """Sums over dimensions of (n x - S)^2, exact: with y the distance from the base, (n y - rest)^2."""
        away, n, rest = _matrix(part, len(self.base)) - self.base, self.moments.n, np.array(self.moments.rest, object)
        size = int(np.abs(away).max(initial=0)) + 1
        if len(self.base) * (n * size) ** 2 < 1 << 62:
            return ((n * away - rest.astype(np.int64)) ** 2).sum(axis=1).tolist()
        if len(self.base) * max(size, n) * size >= 1 << 62:
            away = away.astype(object)
        squares, mixed, own = (away * away).sum(axis=1), away @ (rest if away.dtype == object else rest.astype(np.int64)), int((rest * rest).sum())
        return [n * n * int(a) - 2 * n * int(b) + own for a, b in zip(squares.tolist(), mixed.tolist(), strict=True)]

    @property
    def explained(self) -> np.ndarray:
        return self.values / np.trace(self.moments.covariance)


def fit(rows: DataFrame, dimensions: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the fitted rows (see ``fitted_rows``); None if nothing varies."""
    found = moments(rows, dimensions)
    values, vectors = leading(rows.sparkSession, found.covariance, components)
    return Whitening(found, values, vectors) if len(values) else None


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest entry of the covariance of the whitened fitted rows, less the identity."""
    sent, k = rows.sparkSession.sparkContext.broadcast(model), len(model.values)

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((k, k)), np.zeros(k)
        for part in _parts(batches, "grid"):
            white = sent.value.whiten(part)
            total, first = total + white.T @ white, first + white.sum(axis=0)
        at = np.indices((k + 1, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(np.vstack((total, first)).ravel())], ["i", "j", "amount"])

    summed = rows.mapInArrow(products, "i int, j int, amount double").groupBy("i", "j").agg(F.sum("amount").alias("amount")).collect()  # k (k + 1) rows
    sums = np.zeros((k + 1, k))
    for r in summed:
        sums[r["i"], r["j"]] = r["amount"] / model.moments.n
    return float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())


def transform(vectors: DataFrame, model: Whitening, keep: list[str], vector: str = "embedding") -> DataFrame:
    """(row: struct of ``keep``, deviation: decimal, whitened: array of one number a component) of rows with a grid vector."""
    sent = vectors.sparkSession.sparkContext.broadcast(model)
    rows = vectors.select(F.struct(*keep).alias("row"), grid(vector).alias("grid")).where("grid IS NOT NULL")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part, row = batch.column("grid").slice(at, ROWS_AT_ONCE), batch.column("row").slice(at, ROWS_AT_ONCE)
                white = sent.value.whiten(part)
                listed = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel()))
                yield pa.RecordBatch.from_arrays([row, _decimals(sent.value.deviations(part)), listed], ["row", "deviation", "whitened"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, deviation decimal(38,0), whitened array<double>")


def report(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), one row for each kept row and component."""
    vectors = vectors.select(key, vector)
    rows, dimensions = fitted_rows(vectors.select(grid(vector).alias("grid")))
    model = fit(rows, dimensions, components)
    kind = vectors.schema[key].dataType
    if model is None:
        none = vectors.sparkSession.createDataFrame([], f"{key} {kind.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
        return none
    error, explained = identity_error(rows, model), F.array(*[F.lit(float(x)) for x in model.explained])
    done = transform(vectors, model, [key], vector).select("row", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return done.select(
        F.col("row")[key].alias(key), (F.col("at") + 1).alias("component"), F.lit(model.moments.n).cast("bigint").alias("n"), F.col("deviation").cast("bigint").alias("deviation"),
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
