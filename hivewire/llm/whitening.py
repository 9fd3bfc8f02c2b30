"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 11).

Entries become integers x = floor(1024 * c) + 100000, written once as packed
rows.  The covariance V = Xc'Xc / n (Xc: rows less their mean) is never formed:
every step is one pass over the rows that adds up Xc'(Xc Q) for a thin block Q
(centred before multiplying), a partial sum per task and a grouped sum of its d
rows.  Between the passes the driver holds d x ``BLOCK`` matrices only, however
many rows there are.

A cycle damps the unwanted part of the spectrum [0, smallest Ritz value] with a
Chebyshev polynomial of V applied by its three-term recurrence, orthonormalises
the block (QR) and solves the projected problem (Rayleigh-Ritz).  Cycles end when
the residuals |Vq - eq| certify every wanted component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK = 32              # columns iterated for the wanted components
DEGREE = 16             # of the polynomial, passes per cycle
CERTIFIED = 2e-13       # residual over the largest eigenvalue
SETTLED = 1e-10         # a residual below this that no longer falls is at the rounding of the sums
CYCLES = 60
LARGEST = float(1 << 40)    # entries from here on have no exact integer and count as non-finite


def _matrix(b: pa.RecordBatch, d: int) -> np.ndarray:
    """The packed rows of a batch as integers, one row per vector."""
    col = b.column("x")
    at = np.frombuffer(col.buffers()[1], np.int32, count=len(col) + 1, offset=4 * col.offset)
    return np.frombuffer(col.buffers()[2], np.int64, count=len(col) * d, offset=int(at[0])).reshape(len(col), d)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [r.values.to_numpy().tobytes() for r in b.column("x")]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(rows, pa.binary())], names=["vec_id", "x"])


def _rows(m: np.ndarray) -> pa.RecordBatch:
    """A matrix as numbered rows of columns ``c0, c1, ...``."""
    return pa.RecordBatch.from_arrays([pa.array(np.arange(m.shape[0]), pa.int32())] + [pa.array(m[:, j]) for j in range(m.shape[1])],
                                      names=["i"] + [f"c{j}" for j in range(m.shape[1])])


def _added(packed: DataFrame, d: int, shape: tuple[int, int], part: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """Sum of ``part(rows)`` over all rows: added up per task, then by matrix row."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for b in batches:
            if b.num_rows:
                p = part(_matrix(b, d))
                out = p if out is None else out + p
        if out is not None:
            yield _rows(out)

    cols = [f"c{j}" for j in range(shape[1])]
    got = packed.mapInArrow(task, "i int, " + ", ".join(f"{c} {kind}" for c in cols)).groupBy("i").agg(*[F.sum(c).alias(c) for c in cols])
    out = np.zeros(shape, np.int64 if kind == "long" else np.float64)
    for r in got.collect():     # d rows: the embedding's width, not its number
        out[r["i"]] = list(r)[1:]
    return out


def _sums(x: np.ndarray) -> np.ndarray:
    return np.column_stack((x.sum(axis=0), np.full(x.shape[1], x.shape[0])))


def _times(x: np.ndarray, q: np.ndarray, mean: np.ndarray) -> np.ndarray:
    xc = x - mean
    return xc.T @ (xc @ q)


def _squares(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return np.array([[((x - mean) ** 2).sum()]])


def _white(x: np.ndarray, q: np.ndarray, mean: np.ndarray, e: np.ndarray) -> np.ndarray:
    return ((x - mean) @ q) / np.sqrt(e)


def _products(x: np.ndarray, **how) -> np.ndarray:
    w = _white(x, **how)
    return np.vstack((w.T @ w, w.sum(axis=0)))


def filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` over [0, ``cut``] applied to ``q``
    (``vq`` = V q), scaled to 1 at ``top``: one product with V per degree."""
    half = mid = cut / 2
    s = half / (top - mid)
    first = s
    old, new = q, (vq - mid * q) * (s / half)
    for _ in range(degree - 1):
        nxt = 1 / (2 / first - s)
        old, new = new, (times(new) - mid * new) * (2 * nxt / half) - (s * nxt) * old
        s = nxt
    return new


def leading(times: Callable[[np.ndarray], np.ndarray], d: int, k: int, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric V without negative ones and
    unit eigenvectors in columns, by products ``times(Q)`` = VQ only."""
    b = min(d, max(BLOCK, 2 * k))
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((d, b)))[0]
    last = np.inf
    for _ in range(CYCLES):
        z = times(q)
        h = q.T @ z
        e, r = np.linalg.eigh((h + h.T) / 2)
        e, r = e[::-1], r[:, ::-1]
        q, z = q @ r, z @ r
        if e[0] <= 0:
            return e[:k], q[:, :k]
        rest = float(np.linalg.norm(z[:, :k] - q[:, :k] * e[:k], axis=0).max() / e[0])
        if rest <= CERTIFIED or (rest <= SETTLED and rest > last / 2):
            return e[:k], q[:, :k]
        last = rest
        q = np.linalg.qr(filtered(times, q, z, max(e[-1], 1e-3 * e[0]) if b < d else 1e-3 * e[0], e[0], degree))[0]
    raise RuntimeError(f"components are not certified after {CYCLES} cycles: residual {last}")


def _output(batches: Iterator[pa.RecordBatch], d: int, n: int, s: np.ndarray, how: dict, share: list[float], error: float) -> Iterator[pa.RecordBatch]:
    k = len(share)
    for b in batches:
        if not b.num_rows:
            continue
        x = _matrix(b, d)
        w = _white(x, **how)
        dev = n * x - s
        exact = (dev * dev).sum(axis=1)             # exact modulo 2**64, so exact where it fits
        fits = (dev.astype(np.float64) ** 2).sum(axis=1) < 2.0 ** 63 * (1 - 1e-9)
        m = len(x)
        yield pa.RecordBatch.from_arrays([
            pa.array(b.column("vec_id")).take(pa.array(np.repeat(np.arange(m), k))),
            pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n)),
            pa.array(np.repeat(exact, k), mask=np.repeat(~fits, k)), pa.array(w.reshape(-1)),
            pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
            names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whitened(embeddings: DataFrame, k: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``
    for every usable vector and component 1 to ``k`` (by falling eigenvalue).

    Vectors that are null, empty or hold a null, non-finite or (in absolute
    value) 2**40 or larger entry are dropped, and so are those of another
    length than the most frequent one (of equally frequent ones the longest).
    Repeated rows and null ids each count and give their own rows.  There are
    fewer components where the vectors have fewer dimensions or vary in fewer
    directions (eigenvalues below 1e-12 of the trace are none); a table of equal
    vectors, of a single one or without any gives no rows.  A ``deviation``
    beyond a long is null.  Of equal eigenvalues any orthonormal directions are
    taken; other columns are ignored."""
    spark = prepare(embeddings.sparkSession)
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    v = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    v = v.where(F.size("v") > 0).where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < LARGEST)))
    length = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if length is None:
        return spark.createDataFrame([], out)
    d = length["d"]
    whole = F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT))
    packed = written(v.where(F.size("v") == d).select("vec_id", whole.alias("x")).mapInArrow(_pack, "vec_id long, x binary"), "vectors")

    sums = _added(packed, d, (d, 2), _sums, "long")
    n, s = int(sums[0, 1]), sums[:, 0]
    mean = s / n
    trace = float(_added(packed, d, (1, 1), partial(_squares, mean=mean))[0, 0]) / n
    if trace <= 0:
        return spark.createDataFrame([], out)

    def times(q: np.ndarray) -> np.ndarray:
        return _added(packed, d, q.shape, partial(_times, q=q, mean=mean)) / n

    e, q = leading(times, d, min(k, d))
    e = e[e > 1e-12 * trace]
    how = {"q": q[:, :e.size], "mean": mean, "e": e}
    p = _added(packed, d, (e.size + 1, e.size), partial(_products, **how)) / n
    error = float(np.abs(p[:-1] - np.outer(p[-1], p[-1]) - np.eye(e.size)).max())
    return packed.mapInArrow(partial(_output, d=d, n=n, s=s, how=how, share=list(e / trace), error=error), out)
