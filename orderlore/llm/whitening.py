"""Whitening of embeddings along the components of their covariance, found by spectral divide and conquer."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlore.sources.tables import materialise

SCALE, SHIFT = 64, 1_000_000  # a component c becomes floor(SCALE * c) + SHIFT
MOST = 32  # components that are returned
ROUNDS = 30  # steps of a polar decomposition, at most; six are the rule
FLAT = 8  # a block whose entries off a multiple of the identity are below FLAT * eps * norm has no components of its own


# --- spectral divide and conquer --------------------------------------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix without null space, by dynamically weighted Halley steps.

    Each step is a QR decomposition of the matrix above a multiple of the identity; the weights follow from a lower
    bound of the singular values, which all tend to 1.
    """
    n, eps = len(a), np.finfo(float).eps
    x = a / np.linalg.norm(a, 2)
    low = max(np.linalg.norm(x, -2), eps)
    for _ in range(ROUNDS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2) if low < 1 else 0.0
        root = math.sqrt(1 + d)
        p = root + 0.5 * math.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        both, _ = np.linalg.qr(np.vstack([math.sqrt(r) * x, np.eye(n)]))
        new = q / r * x + (p - q / r) / math.sqrt(r) * both[:n] @ both[n:].T
        new = (new + new.T) / 2
        low = min(low * (p + q * square) / (1 + r * square), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved <= np.cbrt(4 * eps) and abs(1 - low) <= 10 * eps:
            break
    return x


def _sides(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal matrix whose first columns span what belongs to eigenvalues above ``shift``, and their number; None
    if all lie on one side or one is too near."""
    n = len(a)
    near = a - shift * np.eye(n)
    size = np.linalg.norm(near)
    if not size or np.linalg.norm(near, -2) <= n * np.finfo(float).eps * size:
        return None
    projector = (polar(near) + np.eye(n)) / 2
    above = round(float(np.trace(projector)))
    if not 0 < above < n:
        return None
    rng = np.random.default_rng(n)
    basis, _ = np.linalg.qr(projector @ rng.standard_normal((n, above)))
    basis, _ = np.linalg.qr(projector @ basis)  # once more, against rounding
    rest, _ = np.linalg.qr(np.hstack([basis, rng.standard_normal((n, n - above))]))
    rest = rest[:, above:]
    rest -= basis @ (basis.T @ rest)
    rest, _ = np.linalg.qr(rest)
    return np.hstack([basis, rest]), above


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """Two invariant subspaces of a symmetric matrix, by the first of several shifts that separates its eigenvalues."""
    own = np.sort(np.diag(a))
    radius = np.abs(a - np.diag(np.diag(a))).sum(axis=1)
    low, high = float((np.diag(a) - radius).min()), float((np.diag(a) + radius).max())
    for share in (0.5, 0.25, 0.75, 0.1, 0.9):
        if found := _sides(a, float(np.quantile(own, share))):
            return found
    mean = float(own.mean())  # the trace lies between the least and the greatest eigenvalue
    for _ in range(60):
        for shift in (mean, (low + mean) / 2, (mean + high) / 2):
            if found := _sides(a, shift):
                return found
        low, high = (low + mean) / 2, (high + mean) / 2
    return None


def components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    The polar factor of the matrix less a shift has the sign of each eigenvalue, so half of its sum with the identity
    projects on the subspace above the shift. Each subspace is split in the same way until it has one dimension, or
    all its eigenvalues are equal to rounding and any of its bases does.
    """
    n = len(a)
    norm = np.linalg.norm(a)

    def solve(block: np.ndarray) -> np.ndarray:
        size = len(block)
        flat = block - np.trace(block) / max(size, 1) * np.eye(size)
        if size == 1 or np.abs(flat).max() <= FLAT * np.finfo(float).eps * norm:
            return np.eye(size)
        if size == 2:  # one rotation
            angle = 0.5 * math.atan2(2 * block[0, 1], block[0, 0] - block[1, 1])
            return np.array([[math.cos(angle), -math.sin(angle)], [math.sin(angle), math.cos(angle)]])
        found = _split(block)
        if found is None:
            return np.eye(size)
        turn, above = found
        inner = turn.T @ block @ turn
        inner = (inner + inner.T) / 2
        return turn @ _joined(solve(inner[:above, :above]), solve(inner[above:, above:]))

    vectors = solve((a + a.T) / 2)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a) + len(b),) * 2)
    out[: len(a), : len(a)], out[len(a) :, len(a) :] = a, b
    return out


# --- tables -----------------------------------------------------------------------------

def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector is not null and holds finite entries alone, x as array<long>.

    Vectors must be of one length to have a covariance: of several, the most frequent one counts (of equally
    frequent ones the greatest); empty vectors are left out.
    """
    values = F.col(vec).cast("array<double>")
    finite = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(values, lambda c: F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    rows = vectors.where(F.col(vec).isNotNull() & finite & (F.size(vec) > 0)).select(F.col("vec_id").cast("long"), x.alias("x"))
    return rows


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            yield batch, flat.reshape(batch.num_rows, -1)


def _summed(rows: DataFrame, function, size: int) -> np.ndarray:
    """The sum over all rows of ``function``, which makes one row of numbers per chunk of vectors: a matrix of the vectors'
    length squared at most. Each task sums its own, in rows of the matrix that Spark adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _chunks(batches):
            part = np.asarray(function(x), np.float64)
            total = part if total is None else total + part
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "value"]
            )

    cells = rows.select("x").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    got = cells.toPandas()
    out = np.zeros((size, size))
    out[got["i"], got["j"]] = got["value"]
    return out


@dataclass
class Whitening:
    """n vectors with the sums of their entries, and the components: eigenvalues, vectors as columns, share of the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums])

    @property
    def matrix(self) -> np.ndarray:
        """What a centred vector is multiplied with."""
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, most: int = MOST) -> Whitening | None:
    """The whitening of all rows (x array<long>, of one length): two passes over them, of which a row of exact sums and a
    square matrix come back. Components without variance (to rounding) are left out. None without rows."""
    size = rows.select(F.size("x").alias("size")).first()
    if size is None:
        return None
    size = size[0]
    total = lambda i: F.sum(F.col("x")[i].cast("decimal(20,0)")).cast("decimal(38,0)")
    got = rows.agg(F.count("*").alias("n"), F.array(*[total(i) for i in range(size)]).alias("sums")).first()
    fitted = Whitening(got.n, [int(s) for s in got.sums], np.zeros(0), np.zeros((size, 0)), np.zeros(0))
    mean = fitted.mean

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return centred.T @ centred

    covariance = _summed(rows, products, size) / got.n
    values, vectors = components(covariance)
    keep = np.flatnonzero(values > size * np.finfo(float).eps * max(values[0], 0.0))[:most]
    trace = np.trace(covariance)
    fitted.values, fitted.vectors, fitted.explained = values[keep], vectors[:, keep], values[keep] / trace if trace else values[keep]
    return fitted


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry of the whitened rows' covariance less the identity, from two more passes over them."""
    mean, matrix, k = fitted.mean, fitted.matrix, len(fitted.values)
    if not k:
        return 0.0
    center = _summed(rows, lambda x: ((x - mean) @ matrix).sum(axis=0, keepdims=True), k)[0] / fitted.n

    def products(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ matrix - center
        return z.T @ z

    return float(np.abs(_summed(rows, products, k) / fitted.n - np.eye(k)).max())


def _exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of the squares of n * x less the sums; null beyond a long."""
    far = max((abs(n * int(x.max()) - s) for s in sums), default=0)
    near = max((abs(n * int(x.min()) - s) for s in sums), default=0)
    if len(sums) * max(far, near) ** 2 < 1 << 62 and n * max(abs(int(x.max())), abs(int(x.min()))) < 1 << 62:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(axis=1).tolist()
    big = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in big]


def whitened(vectors: DataFrame, vec: str = "embedding", most: int = MOST) -> DataFrame:
    """For each usable row of ``vectors`` (vec_id, the vector, any others) and component up to ``most``: vec_id, component
    (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error.

    Entries c count as floor(SCALE * c) + SHIFT. deviation is the exact sum over dimensions of (n * x - sum)^2; whitened
    the centred vector on the component over the root of its eigenvalue; explained the eigenvalue's share of the
    trace; identity_error one value for all. Statistics are over all usable rows; the components go to the tasks.

    Rows with null or empty vectors, or null or non-finite entries, are dropped, as are vectors of another length than the
    most frequent one (the greater of equally frequent ones). Null ids and repeated rows are rows of their own. Components without variance do
    not exist, so equal vectors alone, or one, give no rows, like empty tables. A deviation beyond a long is null.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = materialise(usable(vectors, vec), "vectors")
    sizes = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size"))
    size = sizes.first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("x") == size[0])
    fitted = fit(rows, most)
    error = identity_error(rows, fitted)
    n, sums, mean, matrix, k = fitted.n, fitted.sums, fitted.mean, fitted.matrix, len(fitted.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _chunks(batches):
            if not k:
                return
            of = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(_exact_deviation(x, n, sums), pa.int64())
            values = ((x - mean) @ matrix).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(of),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(values), n)),
                    deviation.take(of),
                    pa.array(values),
                    pa.array(np.tile(fitted.explained, len(x))),
                    pa.array(np.full(len(values), error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
