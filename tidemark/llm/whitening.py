"""Whitening of embeddings by mixed-precision eigenvectors.

Entries become whole numbers (``floor(SCALE * c)``); the covariance is over the distinct vectors, centred before multiplying,
and summed by cell over all tasks. Its eigenvectors are found in float32 and corrected by Ogita-Aishima iterations, which are
matrix products in extended precision. Eigenvalues too close to part by an iteration form clusters: each is solved
by itself, in the basis that its vectors span and shifted by their mean, and rotated in.

Passes: distinct vectors (packed to the fewest bytes an entry, combined in the map tasks, written once), exact sums,
covariance cells, covariance of the whitened vectors, result. The driver sees sums and cells only: their number is given by the
dimension, not by the rows.

Defined cases: a null vector, one that holds null or non-finite entries, and one without entries give no row; if vectors differ in
length, those of the length that most distinct vectors have count (the longer of equals) and the others give no row; entries beyond
the long range are its ends; ids may be null or repeat; equal vectors count once in the fit; a direction without variance is whitened to
0, explains 0 and is left out of the identity error; a deviation beyond the long range is null; an empty table gives no rows;
other columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Written

SCALE, COMPONENTS = 256, 4
ROUNDS = 12  # corrections at most; three or four do as a rule
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_TOP = float(2**63)


def vectors(arr: pa.Array, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, whole numbers) of the usable vectors, for each length that occurs."""
    if not len(arr):
        return
    off = arr.offsets.to_numpy().astype(np.int64)
    size, there = np.diff(off), arr.is_valid().to_numpy(zero_copy_only=False)
    flat = arr.values.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    there &= (size > 0) & (upto[off[1:]] == upto[off[:-1]])
    for d in np.unique(size[there]).tolist():
        at = np.flatnonzero(there & (size == d))
        with np.errstate(over="ignore"):
            f = np.floor(scale * flat[off[at][:, None] + np.arange(d)])
        x = np.clip(f, -_TOP, _TOP / 2).astype(np.int64)
        x[f > _TOP / 2] = np.clip(f[f > _TOP / 2], 0, np.nextafter(_TOP, 0)).astype(np.int64)
        x[f >= _TOP] = 2**63 - 1
        yield at, x


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in the fewest bytes an entry that hold it, after one byte with their number: equal rows, equal bytes."""
    low, high = x.min(axis=1), x.max(axis=1)
    out = np.empty(len(x), object)
    width = np.select([(low >= -2**(8 * w - 1)) & (high < 2**(8 * w - 1)) for w in (1, 2, 4)], (1, 2, 4), 8)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        raw, n = x[at].astype(f"<i{w}").tobytes(), w * x.shape[1]
        out[at] = [bytes([w]) + raw[i:i + n] for i in range(0, n * len(at), n)]
    return out.tolist()


def unpacked(rows: list[bytes]) -> np.ndarray:
    """The whole numbers of packed rows of one length."""
    d = (len(rows[0]) - 1) // rows[0][0]
    x = np.empty((len(rows), d), np.int64)
    width = np.array([r[0] for r in rows])
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        raw = np.frombuffer(b"".join([rows[i] for i in at.tolist()]), np.uint8).reshape(len(at), 1 + w * d)
        x[at] = np.ascontiguousarray(raw[:, 1:]).view(f"<i{w}")
    return x


def refined(cov: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a symmetric matrix: float32 first, then corrected."""
    d = len(cov)
    norm = float(np.abs(cov).max(initial=0)) or 1.0
    a = (cov / norm).astype(np.longdouble)
    x = np.linalg.eigh((cov / norm).astype(np.float32))[1].astype(np.longdouble)
    one, eps = np.eye(d, dtype=np.longdouble), np.finfo(np.longdouble).eps
    size = max(np.sqrt((a * a).sum()), eps)
    for _ in range(rounds):
        r, s = one - x.T @ x, x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding over a small gap turns vectors out of the right angle
        lam = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(lam)
        # over a gap below the root of the precision, the square of the rounding alone would spoil the right angles
        least = max(2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum())), np.sqrt(eps) * size)
        near = np.abs(lam[None, :] - lam[:, None]) <= least
        gap = np.where(near, 1, lam[None, :] - lam[:, None])
        x = x + x @ np.where(near, r / 2, (s + lam[None, :] * r) / gap)
        # what the iteration could not part is solved in its own basis
        order = np.argsort(lam, kind="stable")
        clusters = _clusters(order, near)
        for at in clusters:
            b = x[:, at]
            mean = lam[at].mean()
            t = b.T @ (a @ b) - mean * (b.T @ b)
            scale = np.abs(t).max()
            if scale > 0:
                x[:, at] = b @ np.linalg.eigh(((t + t.T) / (2 * scale)).astype(np.float64))[1].astype(np.longdouble)
        rest = max(float(np.abs(one - x.T @ x).max(initial=0)), float(np.abs(off[~near]).max(initial=0)))
        if rest <= (4 * np.finfo(float).eps if clusters else 64 * d * eps):
            break
    x = x / np.sqrt((x * x).sum(axis=0))
    lam = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-lam, kind="stable")
    x, lam = x[:, order].astype(np.float64), np.maximum(lam[order], 0).astype(np.float64) * norm
    sign = np.where(x[np.abs(x).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0) if d else 1.0
    return lam, x * sign


def _clusters(order: np.ndarray, near: np.ndarray) -> list[np.ndarray]:
    """Runs of two or more neighbours, by falling or rising value, that are near to the next."""
    out, run = [], list(order[:1])
    for i in order[1:]:
        if not near[run[-1], i]:
            out.append(run)
            run = []
        run.append(i)
    return [np.array(r) for r in [*out, run] if len(r) > 1]


class Whitening:
    """What a fit gives: number and sums of the distinct vectors, components and their variances."""

    def __init__(self, n: int, sums: list[int], cov: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        lam, vec = refined(cov)
        total = math.fsum(np.diag(cov))
        k = min(components, len(sums))
        lam = np.where(lam[:k] > len(sums) * np.finfo(float).eps * total, lam[:k], 0.0)
        self.vectors, self.flat = vec[:, :k], lam == 0
        self.explained = lam / total if total else lam
        self.scale = np.where(self.flat, 0.0, 1 / np.sqrt(np.where(self.flat, 1.0, lam)))
        self.error: float | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: as long where it and its sum of squares fit, else as Python's whole numbers."""
        most = self.n * max(int(x.max()), -int(x.min())) + max(map(abs, self.sums))
        if most**2 * len(self.sums) < 2**63:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return (y.astype(np.float64) / self.n) @ self.vectors * self.scale


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    def run(batches):
        n, high, low = 0, 0, 0
        for b in batches:
            if b.num_rows:
                x = unpacked(b.column(0).to_pylist())
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_pydict({"i": np.arange(len(high), dtype=np.int32), "n": np.full(len(high), n), "high": high, "low": low})

    rows = (fit.select("x").mapInArrow(run, "i int, n long, high long, low long").groupBy("i")
            .agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]).orderBy("i").collect())
    return int(rows[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _gram(fit: DataFrame, d: int, centred) -> np.ndarray:
    """Sum of the outer products of ``centred(x)`` over all vectors: ``d`` by ``d``, by cell."""
    row, col = np.triu_indices(d)

    def run(batches):
        c = np.zeros((d, d))
        for b in batches:
            if b.num_rows:
                y = centred(unpacked(b.column(0).to_pylist()))
                c += y.T @ y
        yield pa.RecordBatch.from_pydict({"i": np.arange(len(row), dtype=np.int32), "v": c[row, col]})

    cells = fit.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((d, d))
    for i, v in cells:
        out[row[i], col[i]] = out[col[i], row[i]] = v
    return out


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fits on each distinct vector once; None if there is none."""
    def run(batches):
        for b in batches:
            for _, x in vectors(b.column(0)):
                yield pa.RecordBatch.from_pydict({"d": np.full(len(x), x.shape[1], np.int32), "x": pa.array(packed(x), pa.binary())})

    kept = Written(rows.select(rows[vector_col].alias("e")).mapInArrow(run, "d int, x binary").distinct(), "vectors")
    try:
        first = kept.df.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
        if first is None:
            return None
        same = kept.df.where(F.col("d") == first["d"])
        n, sums = _sums(same)
        mean = np.array([float(Fraction(s, n)) for s in sums])
        model = Whitening(n, sums, _gram(same, len(sums), lambda x: x - mean) / n, components)
        cov = _gram(same, len(model.scale), lambda x: model.whitened(model.scaled(x))) / n
        model.error = float(np.abs(cov - np.diag(np.where(model.flat, 0.0, 1.0))).max())
        return model
    finally:
        kept.drop()


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable vector and component."""
    model = fit(rows, vector_col, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    k = len(model.scale)

    def run(batches):
        for b in batches:
            for at, x in vectors(b.column(1)):
                if x.shape[1] != len(model.sums):
                    continue
                y = model.scaled(x)
                dev = [v if v < 2**63 else None for v in (y * y).sum(axis=1).tolist()]
                dev = pa.array(dev, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": b.column(0).take(pa.array(np.repeat(at, k))), "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(at)),
                    "n": np.full(k * len(at), model.n), "deviation": dev, "whitened": model.whitened(y).ravel(),
                    "explained": np.tile(model.explained, len(at)), "identity_error": np.full(k * len(at), model.error)})

    return rows.select(rows[id_col].cast("long").alias("vec_id"), rows[vector_col].alias("e")).mapInArrow(run, SCHEMA)
