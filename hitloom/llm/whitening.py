"""Whitening of embeddings, with eigenvectors refined from float32 to double precision.

Vectors are read as whole numbers, ``floor(SCALE * c)``, so counts, sums and
products are exact however tasks are cut. The mean and covariance are those of
the different vectors, each once: a shuffle that tasks pre-aggregate removes
copies, then every task adds up products of its centred vectors (less the mean
rounded to a whole number; what that leaves out is added back exactly) as one
float64 matrix product a block. Only matrices of the dimension reach the driver.

Eigenvectors start as float32 ones and are corrected by iterations that consist
of matrix products only, in extended precision (Ogita and Aishima): from
``R = I - X'X`` and ``S = X'AX`` follow better eigenvalues ``s_ii / (1 - r_ii)``
and a correction ``X + XE`` whose error is the square of the one before.
Where eigenvalues lie too close to tell apart at the present accuracy, the
correction only keeps the vectors orthogonal; such a cluster is solved as a
problem of its own, ``X_J'(A - mu I)X_J``, whose gaps are large again relative to
its size, and its vectors are turned by the result before the next iteration.

Defined cases: rows without a vector, with a null, NaN or infinite entry, or of
another length than most different vectors (an empty one too) are left out;
products beyond a long make ``deviation`` null, and entries beyond one are cut to
its range; components without variance have null ``whitened`` values; null and
repeated keys and repeated vectors are rows like any other; an empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitloom.llm.common import empty, saved

SCALE = 256

#: Vectors of a block of which products are taken at once; sums of float64 products stay exact for entries below 2**20.
BLOCK = 4_096

#: The covariance is a matrix on the driver.
MAX_DIMENSION = 4_096

ROUNDS = 30

_LIMB = 40
_MASK = (1 << _LIMB) - 1


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """The entries as longs; null for vectors with nulls or entries that are no numbers."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite, F.transform(wide, lambda c: F.floor(c * scale)))


# --- sums over all vectors -------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for low in range(0, batch.num_rows, BLOCK):
            part = batch.column(0).slice(low, BLOCK)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)


def _limbs(values: list[int], i: list[int], j: list[int]) -> pa.RecordBatch:
    """Whole numbers of any size as three longs each, whose sums over many tasks stay exact."""
    parts = [[v >> 2 * _LIMB for v in values], [v >> _LIMB & _MASK for v in values], [v & _MASK for v in values]]
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32())] + [pa.array(p, pa.int64()) for p in parts],
        names=["i", "j", "a", "b", "c"],
    )


def _totals(parts: DataFrame) -> dict[tuple[int, int], int]:
    summed = parts.groupBy("i", "j").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("c").alias("c"))
    return {(r.i, r.j): (r.a << 2 * _LIMB) + (r.b << _LIMB) + r.c for r in summed.collect()}


_PARTS = "i int, j int, a long, b long, c long"


def _sums(fit: DataFrame) -> dict[tuple[int, int], int]:
    """Number of vectors at (-1, -1), the sum of each dimension at (i, -1)."""

    def run(batches):
        n, high, low = 0, 0, 0
        for x in _blocks(batches):
            n += len(x)
            high = high + (x >> 32).sum(axis=0)
            low = low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            sums = [(int(h) << 32) + int(k) for h, k in zip(high, low)]
            yield _limbs([n, *sums], list(range(-1, len(sums))), [-1] * (len(sums) + 1))

    return _totals(fit.mapInArrow(run, _PARTS))


def _products(fit: DataFrame, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of products of the dimensions' distances from ``centre`` (the upper triangle)."""
    i, j = np.triu_indices(len(centre))

    def run(batches):
        total = None
        for x in _blocks(batches):
            z = x.astype(np.float64) - centre
            block = (z.T @ z)[i, j].tolist()
            total = [int(v) for v in block] if total is None else [t + int(v) for t, v in zip(total, block)]
        if total:
            yield _limbs(total, i.tolist(), j.tolist())

    return _totals(fit.mapInArrow(run, _PARTS))


def covariance(n: int, sums: list[int], centre: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance in extended precision; exact but for one rounding of each entry."""
    rest = [s - n * m for s, m in zip(sums, centre)]
    d = len(sums)
    out = np.zeros((d, d), dtype=np.longdouble)
    for (i, j), value in products.items():
        out[i, j] = out[j, i] = np.longdouble(n * value - rest[i] * rest[j]) / np.longdouble(n) / np.longdouble(n)
    return out


# --- eigenvectors ------------------------------------------------------------------


def _norm(m: np.ndarray) -> np.longdouble:
    return np.sqrt((m * m).sum())


def _clusters(values: np.ndarray, gap: np.longdouble) -> list[np.ndarray]:
    """Numbers of the values that lie within ``gap`` of their neighbour, in groups of two or more."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _orthogonal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns, made so to the precision of the type."""
    eye = np.eye(x.shape[1], dtype=x.dtype)
    for _ in range(2):
        x = x @ (1.5 * eye - 0.5 * (x.T @ x))
    return x


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.longdouble]:
    """One iteration: better vectors, and the size of their correction."""
    floor = 2 * len(a) * np.finfo(np.longdouble).eps * _norm(a)
    r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    # Corrections stay below a tenth, so that the next error is far smaller.
    unsure = 10 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r)) + floor
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > unsure
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    x = x + x @ e
    change = np.abs(e).max()
    for j in _clusters(values, unsure):
        # What is left of the cluster: its size is that of its gaps, so an ordinary solver tells them apart.
        part = _orthogonal(x[:, j])
        sub = part.T @ (a @ part) - values[j].mean() * np.eye(len(j), dtype=np.longdouble)
        if np.abs(sub - np.diag(np.diag(sub))).max() > floor:  # else equal as far as can be told
            _, turn = np.linalg.eigh(((sub + sub.T) / (2 * np.abs(sub).max())).astype(np.float64))
            part, change = part @ _orthogonal(turn.astype(np.longdouble)), np.longdouble(1)
        x[:, j] = part
    return x, change


def eigen(a: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix, in extended precision.

    The largest entry of each vector is positive.
    """
    a = a.astype(np.longdouble)
    size = np.abs(a).max() if a.size else np.longdouble(0)
    if not size:
        return np.zeros(len(a), dtype=np.longdouble), np.eye(len(a), dtype=np.longdouble)
    scaled = a / size
    x = np.linalg.eigh(scaled.astype(np.float32))[1].astype(np.longdouble)
    enough = len(a) * np.finfo(np.longdouble).eps
    before = np.longdouble(np.inf)
    for _ in range(rounds):
        x, change = _corrected(scaled, x)
        if change <= enough or (before < 1e-9 and change >= before):  # no better: rounding is all that is left
            break
        before = change
    x = _orthogonal(x)
    values = (x * (scaled @ x)).sum(axis=0) * size
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order], x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(x))] < 0, -1, 1)


# --- the operator ---------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """A fitted transformation: ``(x - sums / n) @ vectors / sqrt(values)``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def _distances(self, x: np.ndarray) -> np.ndarray:
        """``x - sums / n``, rounded once where it can be."""
        n = np.longdouble(self.n)
        mean = np.array([np.longdouble(s) / n for s in self.sums])
        return (x.astype(np.longdouble) - mean).astype(np.float64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            root = np.where(self.values > 0, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return self._distances(x) @ self.vectors / root

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact sums of ``(n * x - sums)**2``, and which of them are no longs."""
        about = self._distances(x) * self.n
        size = np.einsum("ij,ij->i", about, about)
        # Arithmetic modulo 2**64 is exact where the result fits.
        wrap = np.array([s & 0xFFFFFFFFFFFFFFFF for s in self.sums], dtype=np.uint64)
        y = x.astype(np.uint64) * np.uint64(self.n & 0xFFFFFFFFFFFFFFFF) - wrap
        return (y * y).sum(axis=1, dtype=np.uint64).astype(np.int64), size > 9.2e18


def fit(distinct: DataFrame, components: int = 4) -> Whitening | None:
    """Fit on a written table with one column of different vectors of one length; None if there are none."""
    sums = _sums(distinct)
    if not sums:
        return None
    n = sums.pop((-1, -1))
    total = [sums[k, -1] for k in range(len(sums))]
    centre = [(2 * s + n) // (2 * n) for s in total]
    products = _products(distinct, np.array([float(m) for m in centre]))
    v = covariance(n, total, centre, products)
    values, vectors = eigen(v)
    trace = np.trace(v)
    noise = trace * len(total) * np.finfo(np.float64).eps
    k = min(components, len(total))
    kept = np.where(values[:k] > noise, values[:k], 0)
    return Whitening(n, tuple(total), kept.astype(np.float64), vectors[:, :k].astype(np.float64), float(trace))


def _identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """How far the covariance of the whitened vectors is from the identity."""
    used = np.flatnonzero(model.values > 0)
    if not len(used):
        return None
    names = [f"w{k}" for k in used]

    def run(batches):
        for x in _blocks(batches):
            w = model.whitened(x)[:, used]
            yield pa.RecordBatch.from_arrays([pa.array(w[:, k]) for k in range(len(used))], names=names)

    rows = distinct.mapInArrow(run, ", ".join(f"{c} double" for c in names))
    pairs = [(a, b) for k, a in enumerate(names) for b in names[k:]]
    found = rows.agg(*(F.covar_pop(a, b).alias(f"{a}{b}") for a, b in pairs)).first()
    return max(abs(value - (a == b)) for (a, b), value in zip(pairs, found))


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 4, scale: int = SCALE) -> DataFrame:
    """A row for each vector and component: (key, component, n, deviation, whitened, explained, identity_error).

    ``explained`` is the component's share of the variance; ``identity_error`` says
    how far the covariance of the whitened vectors is from the identity at most.
    """
    spark = df.sparkSession
    id_type = dict(df.dtypes)[key]
    schema = f"`{key}` {id_type}, {OUT}"
    rows = df.select(whole_numbers(F.col(f"`{vector}`"), scale).alias("x"), F.col(f"`{key}`").alias("key")).filter("size(x) > 0")
    distinct = saved(rows.select("x").distinct(), "vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    if lengths is None:
        return empty(spark, schema)
    if lengths.d > MAX_DIMENSION:
        raise ValueError(f"{lengths.d} dimensions: the covariance of more than {MAX_DIMENSION} does not fit on the driver")
    distinct = distinct.filter(F.size("x") == lengths.d)
    model = fit(distinct, components)
    error = _identity_error(distinct, model)
    k = len(model.values)
    share = model.values / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                deviation, beyond = model.deviations(x)
                w = model.whitened(x).ravel()
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(1).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), model.n, dtype=np.int64)),
                        pa.array(deviation[each], mask=beyond[each]),
                        pa.array(w, mask=np.isnan(w)),
                        pa.array(np.tile(share, len(x))),
                        pa.array([error] * len(each), pa.float64()),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.filter(F.size("x") == lengths.d).mapInArrow(run, schema)
