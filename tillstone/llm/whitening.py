"""Whitening of embeddings by incremental eigendecomposition.

Each partition keeps the eigendecomposition of its own scatter matrix and takes
in one vector after another as a centred rank-one update: deflation, roots of
the secular equation, eigenvectors by Loewner's formula. Two spectra combine by
as many rank-one updates as the second has eigenvalues, and one for the distance
of their means; a tree of bounded groups does that over all partitions. The
basis that comes out is refined once by Rayleigh-Ritz: the covariance in that
basis is summed over all vectors, centred with the exact mean, and diagonalised.

What leaves a partition, and what reaches the driver at the end, is a few square
matrices of the vectors' dimension, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import settle

EPS = np.finfo(np.float64).eps
SUMMARY = "part long, n long, sums array<string>, mean array<double>, values array<double>, vectors array<double>"
MOMENTS = "part long, n long, mean array<double>, second array<double>"


@dataclass(frozen=True)
class Whitening:
    """``scale`` and ``shift`` make integers of the entries, which ``bound`` clips (no embedding comes near it);
    ``components`` are returned, but none below ``rank_share`` of the largest eigenvalue, as there is nothing to scale.
    ``width`` spectra meet in one task."""

    scale: int = 1024
    shift: int = 100_000
    bound: int = 2**40
    components: int = 8
    rank_share: float = 1e-11
    width: int = 8


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z' and the matrix d_j - lambda_i. ``d`` ascends without ties, ``z`` has no zero, ``rho`` > 0.

    Root i lies between d_i and the next pole. It is kept as a distance from the
    nearer pole, found by two-pole interpolation and halved where that leaves its bracket.
    """
    k, z2 = len(d), z * z
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    gap = upper - d
    poles = d[None, :]
    middle = 1 / rho + (z2 / (poles - (d + gap / 2)[:, None])).sum(axis=1)
    right = middle < 0
    right[-1] = False
    origin = np.where(right, upper, d)
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(np.arange(k) == k - 1, gap, gap / 2))
    tau = (low + high) / 2
    at_left = np.tril(np.ones((k, k), bool))
    from_origin = poles - origin[:, None]
    i, last = np.arange(k), k - 1
    open_ = np.arange(k)
    for _ in range(200):
        delta = from_origin[open_] - tau[open_, None]
        terms = z2 / delta
        slopes = terms / delta
        left = at_left[open_]
        f = 1 / rho + terms.sum(axis=1)
        size = 1 / rho + np.abs(terms).sum(axis=1)
        t = tau[open_]
        low[open_], high[open_] = np.where(f < 0, t, low[open_]), np.where(f < 0, high[open_], t)
        narrow = high[open_] - low[open_] <= 2 * EPS * np.maximum(np.abs(low[open_]), np.abs(high[open_]))
        going = (np.abs(f) > k * EPS * size) & ~narrow
        if not going.any():
            break
        open_, delta, f = open_[going], delta[going], f[going]
        psi = (slopes * left)[going].sum(axis=1)
        phi = (slopes * ~left)[going].sum(axis=1)
        rows = np.arange(len(open_))
        a_pole, b_pole = delta[rows, open_], delta[rows, np.minimum(open_ + 1, last)]
        with np.errstate(all="ignore"):
            c = f - a_pole * psi - b_pole * phi
            a = (a_pole + b_pole) * f - a_pole * b_pole * (psi + phi)
            b = a_pole * b_pole * f
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            c = f - a_pole * psi
            step = np.where(open_ == last, a_pole + a_pole * a_pole * psi / c, step)
            new = tau[open_] + step
        inside = np.isfinite(new) & (new > low[open_]) & (new < high[open_])
        tau[open_] = np.where(inside, new, (low[open_] + high[open_]) / 2)
    return origin + tau, from_origin - tau[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, ascending, and eigenvectors after adding rho * (vectors z)(vectors z)'."""
    tol = 8 * EPS * max(values[-1], rho * float(z @ z))
    if tol == 0:
        return values, vectors
    # Deflation: of equal eigenvalues a reflection leaves one with a part in the update ...
    cuts = np.flatnonzero(np.diff(values) > tol) + 1
    if len(cuts) < len(values) - 1:
        z, vectors = z.copy(), vectors.copy()
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(values)]):
            length = np.linalg.norm(z[a:b])
            if b - a > 1 and length > 0:
                w = z[a:b].copy()
                w[-1] += np.copysign(length, w[-1])
                w /= np.linalg.norm(w)
                vectors[:, a:b] -= 2 * np.outer(vectors[:, a:b] @ w, w)
                z[b - 1], z[a : b - 1] = -np.copysign(length, z[b - 1]), 0
    # ... and directions that the update does not touch stay as they are.
    touched = rho * np.abs(z) * np.linalg.norm(z) > tol
    if not touched.any():
        return values, vectors
    d, w = values[touched], z[touched]
    k = len(d)
    found, delta = secular_roots(d, w, rho)
    # The update whose exact eigenvalues the computed roots are; its eigenvectors are orthogonal.
    apart = d[None, :] - d[:, None]
    below = np.tril(np.ones((k, k), bool), -1)  # root i below pole j: i < j
    divisor = np.where(below.T, apart, np.vstack([apart[1:], np.ones((1, k))]))
    w = np.copysign(np.sqrt(np.prod(np.abs(delta / divisor), axis=0)), w)
    turned = w / delta
    turned /= np.linalg.norm(turned, axis=1)[:, None]
    values, vectors = values.copy(), vectors.copy()
    values[touched] = found
    vectors[:, touched] = vectors[:, touched] @ turned.T
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, sums, mean, and the eigendecomposition of the scatter matrix of some vectors."""

    dim: int
    n: int = 0
    sums: list[int] = field(default_factory=list)
    mean: np.ndarray = None
    values: np.ndarray = None
    vectors: np.ndarray = None

    def __post_init__(self):
        if self.mean is None:
            self.sums, self.mean = [0] * self.dim, np.zeros(self.dim)
            self.values, self.vectors = np.zeros(self.dim), np.eye(self.dim)

    def add(self, x: np.ndarray) -> None:
        away = x - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ away, (self.n - 1) / self.n)

    def combine(self, other: Spectrum) -> None:
        away, n = other.mean - self.mean, self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ vector, value)
        if self.n and other.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ away, self.n * other.n / n)
        self.mean = self.mean + away * (other.n / n) if n else self.mean
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums)]

    def row(self, part: int) -> tuple:
        return part, self.n, [str(s) for s in self.sums], self.mean, self.values, self.vectors.ravel()

    @staticmethod
    def of(row) -> Spectrum:
        dim = len(row.mean)
        return Spectrum(dim, row.n, [int(s) for s in row.sums], np.array(row.mean), np.array(row.values), np.array(row.vectors).reshape(dim, dim))


def vectors_of(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding) of the rows that remain, and their dimension.

    A vector that is NULL, or holds a NULL or non-finite entry, goes. So do
    empty ones, and those of another length than most have (of two lengths as
    frequent the larger stays): they are in no common space.
    """
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & sound & (F.size("embedding") > 0))
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    dim = sizes.agg(F.max(F.struct("n", "dim")).alias("x")).first().x
    dim = dim.dim if dim else 0
    return rows.filter(F.size("embedding") == dim), dim


def integers(batch: pd.DataFrame, how: Whitening) -> np.ndarray:
    x = np.stack(batch["embedding"].to_numpy()).astype(np.float64)
    return np.floor(np.clip(x * how.scale, -how.bound, how.bound)).astype(np.int64) + how.shift


def tree(parts: DataFrame, merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str, width: int):
    """The one row that is left when ``merge`` has joined the rows of each ``width`` neighbouring parts again and again."""
    parts = settle(parts, "whitening-parts")
    count = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while count > 1:
        parts = parts.groupBy(F.floor(F.col("part") / width).alias("to")).applyInPandas(merge, schema)
        count = -(-count // width)
    return parts.first()


def spectra(rows: DataFrame, dim: int, how: Whitening) -> Spectrum:
    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = Spectrum(dim)
        for batch in batches:
            if len(batch):
                x = integers(batch, how)
                mine.sums = [a + int(b) for a, b in zip(mine.sums, x.sum(axis=0))]
                for v in x.astype(np.float64):
                    mine.add(v)
        if mine.n:
            yield pd.DataFrame([mine.row(TaskContext.get().partitionId())], columns=["part", "n", "sums", "mean", "values", "vectors"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = list(rows.sort_values("part").itertuples())
        mine = Spectrum.of(rows[0])
        for row in rows[1:]:
            mine.combine(Spectrum.of(row))
        return pd.DataFrame([mine.row(rows[0].part // how.width)], columns=["part", "n", "sums", "mean", "values", "vectors"])

    return Spectrum.of(tree(rows.mapInPandas(fit, SUMMARY), merge, SUMMARY, how.width))


def moments(rows: DataFrame, project: Callable[[np.ndarray], np.ndarray], how: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance (divisor n) of ``project`` over all rows; centred before multiplying, part by part."""

    def combine(n, mean, second, m, other_mean, other_second):
        away = other_mean - mean
        return n + m, mean + away * (m / (n + m)), second + other_second + np.outer(away, away) * (n * m / (n + m))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now = None
        for batch in batches:
            if len(batch):
                y = project(integers(batch, how))
                mean = y.mean(axis=0)
                one = len(y), mean, (y - mean).T @ (y - mean)
                now = combine(*now, *one) if now else one
        if now:
            yield pd.DataFrame([(TaskContext.get().partitionId(), now[0], now[1], now[2].ravel())], columns=["part", "n", "mean", "second"])

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows, now = rows.sort_values("part"), None
        for n, mean, second in zip(rows["n"], rows["mean"], rows["second"]):
            one = n, np.array(mean), np.array(second).reshape(len(mean), -1)
            now = combine(*now, *one) if now else one
        return pd.DataFrame([(rows["part"].iloc[0] // how.width, now[0], now[1], now[2].ravel())], columns=["part", "n", "mean", "second"])

    row = tree(rows.mapInPandas(gather, MOMENTS), merge, MOMENTS, how.width)
    return np.array(row.mean), np.array(row.second).reshape(len(row.mean), -1) / row.n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum of (n * x - S) ** 2 over the dimensions, exact; NULL where it is no 64-bit number."""
    most = max(np.abs(x).max(initial=0) * float(n), *(abs(float(s)) for s in sums))
    if most < 2**61:
        t = n * x - np.array(sums, np.int64)
        if float(np.abs(t).max(initial=0)) ** 2 * x.shape[1] < 2**62:
            return (t * t).sum(axis=1).tolist()
    exact = (sum((n * int(a) - s) ** 2 for a, s in zip(v, sums)) for v in x)
    return [e if e < 2**63 else None for e in exact]


def whiten(embeddings: DataFrame, how: Whitening = Whitening()) -> DataFrame:
    """One row for each remaining row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Repeated rows count as often as they come. A table without variance, with
    one row or with none gives no rows: it has no components. Entries whose
    scaled value is beyond ``bound`` are clipped there.
    """
    rows, dim = vectors_of(embeddings)
    schema = f"vec_id {embeddings.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dim:
        return embeddings.sparkSession.createDataFrame([], schema)
    fitted = spectra(rows, dim, how)
    n, sums = fitted.n, fitted.sums
    mean = np.array([s / n for s in sums])
    basis = np.linalg.qr(fitted.vectors)[0]
    spread = moments(rows, lambda x: (x - mean) @ basis, how)[1]
    values, turn = np.linalg.eigh((spread + spread.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    top = values[: how.components]
    kept = int((top > how.rank_share * values[0]).sum()) if values[0] > 0 else 0
    if not kept:
        return embeddings.sparkSession.createDataFrame([], schema)
    axes = (basis @ turn)[:, :kept] / np.sqrt(top[:kept])
    explained = top[:kept] / values.sum()
    whitened = lambda x: (x - mean) @ axes
    error = float(np.abs(moments(rows, whitened, how)[1] - np.eye(kept)).max())

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = integers(batch, how)
            out = pd.DataFrame({
                "vec_id": batch["vec_id"].repeat(kept).reset_index(drop=True),
                "component": np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x)),
                "n": n,
                "deviation": pd.array(deviations(x, n, sums), "Int64").repeat(kept),
                "whitened": whitened(x).ravel(),
                "explained": np.tile(explained, len(x)),
                "identity_error": error,
            })
            yield out

    return rows.mapInPandas(write, schema)


def op12(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)
