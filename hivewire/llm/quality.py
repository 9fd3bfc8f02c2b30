"""Quality classifier: regularised quadratic discriminant analysis (operator 9).

Every document becomes a vector of transformed statistics of its whole text.
Class means and covariances are exact sums over all labelled rows of the
training folds (a grouped aggregate, nothing sampled); covariances are shrunk
towards their diagonal and a share of the pooled variances.  A score is the
posterior of class 1: the difference of two Mahalanobis log-densities, each
with the inverse Cholesky factor that is computed once per fit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, unused, word_hashes, written

FEATURES = ("log_bytes", "log_words", "word_len", "distinct", "common_word", "repeats", "upper", "digits", "punct",
            "symbols", "spaces", "lines", "sentence_len", "line_repeats")
SHRINK, RIDGE = 0.1, 0.05          # towards the diagonal; share of the pooled variances
REJECT_BELOW = 0.1                 # documents are rejected when class 0 is nine times likelier
HELD_OUT_FOLD, FOLDS = 1, 3


def _byte_classes() -> np.ndarray:
    c = np.full(256, 6, dtype=np.intp)                    # symbols
    c[np.arange(0x80, 0x100)] = 0                         # parts of letters beyond ASCII
    c[np.arange(ord("a"), ord("z") + 1)] = 0
    c[np.arange(ord("A"), ord("Z") + 1)] = 1
    c[np.arange(ord("0"), ord("9") + 1)] = 2
    c[[ord(x) for x in ".,;:?'\"()-"]] = 3
    c[[0x20, 9, 11, 12, 13]] = 4
    c[10] = 5
    return c


_CLASS = _byte_classes()


def features(text: bytes | None) -> np.ndarray:
    """Transformed statistics of one text; an empty or null text has its own
    constant vector."""
    t = text or b""
    n = len(t)
    _, upper, digit, punct, space, line, symbol = np.bincount(_CLASS[np.frombuffer(t, dtype=np.uint8)], minlength=7)
    h, _ = word_hashes(t)
    words = h.size
    _, counts = np.unique(h, return_counts=True) if words else (None, np.zeros(1))
    lines = [x for x in t.split(b"\n") if x]
    share = lambda x, of: math.log((x + 0.5) / (of + 50))
    return np.array([
        math.log1p(n), math.log1p(words), math.log((n + 1) / (words + 1)),
        math.log(counts.size + 1) - 0.85 * math.log(words + 1), math.log((counts.max() + 1) / (words + 10)),
        share(int((h[1:] == h[:-1]).sum()), words), share(upper, n), share(digit, n), share(punct, n), share(symbol, n),
        math.log((space + line + 1) / (n + 5)), share(line, n), math.log((words + 1) / (t.count(b".") + 1)),
        share(len(lines) - len(set(lines)), len(lines)),
    ])


def matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))


@dataclass(frozen=True)
class Discriminant:
    """A fitted model; without rows of both classes ``score`` is the constant ``prior``."""

    prior: float
    means: tuple | None = None
    factors: tuple | None = None      # inverse Cholesky factors
    logdets: tuple | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        d = []
        for mean, inv, logdet in zip(self.means, self.factors, self.logdets):
            z = (x - mean) @ inv.T
            d.append(-0.5 * ((z * z).sum(axis=1) + logdet))
        odds = d[1] - d[0] + math.log(self.prior / (1 - self.prior))
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))


def solve(stats: dict[int, tuple[int, np.ndarray, np.ndarray]], shrink: float = SHRINK, ridge: float = RIDGE) -> Discriminant:
    """Model from (rows, sums, sums of products) of the classes 0 and 1."""
    n = {k: stats[k][0] if k in stats else 0 for k in (0, 1)}
    prior = (n[1] + 1) / (n[0] + n[1] + 2)
    if min(n.values()) < 2:
        return Discriminant(prior)
    means, covs = [], []
    for k in (0, 1):
        m = stats[k][1] / n[k]
        means.append(m)
        covs.append(stats[k][2] / n[k] - np.outer(m, m))
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / (n[0] + n[1])
    factors, logdets = [], []
    for c in covs:
        c = (1 - shrink) * c + shrink * np.diag(np.diag(c)) + ridge * np.diag(np.diag(pooled)) + 1e-9 * np.eye(len(c))
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        logdets.append(2 * float(np.log(np.diag(low)).sum()))
    return Discriminant(prior, tuple(means), tuple(factors), tuple(logdets))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = matrix(b.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(x[:, i]) for i in range(x.shape[1]))],
                                         names=["doc_id", *FEATURES])


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every document, in one pass."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
        .mapInArrow(_feature_rows, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def fold(id_col="doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def fit(feats: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant:
    """Fit on all rows of ``feats`` whose fold is not held out and whose label is
    0 or 1.  Only class sums (two rows) reach the driver."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y")).where("y IN (0, 1)")
    rows = feats.where(fold() != HELD_OUT_FOLD).join(y, "doc_id")
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    got = rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f).alias(f"s_{f}") for f in FEATURES),
                                *(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p_{i}_{j}") for i, j in pairs))
    stats = {}
    for r in got.collect():
        p = np.zeros((d, d))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p_{i}_{j}"]
        stats[int(r["y"])] = (r["n"], np.array([r[f"s_{f}"] for f in FEATURES]), p)
    return solve(stats)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Null and empty texts are scored like any text by their (constant)
    statistics; a null id is scored, never held out and never learnt from;
    repeated ids are scored row by row; labels other than 0 and 1 are ignored.
    Without labels of both classes the score is the share of class 1
    (0.5 without any).  An empty table gives no rows; other columns of either
    table are ignored."""
    prepare(docs.sparkSession)
    feats = written(feature_table(docs), "features")
    model = fit(feats, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy() for f in FEATURES])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])

    return feats.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", F.coalesce(fold() == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, least: float = REJECT_BELOW) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score is at least ``least``."""
    prepare(docs.sparkSession)
    model = fit(written(feature_table(docs), "features"), labels)
    names, at = docs.columns, unused(docs, "quality_text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = model.score(matrix(b.column(at).to_pylist())) >= least
            yield b.select(names).filter(pa.array(ok))

    return docs.withColumn(at, F.col("text").cast("string").cast("binary")).mapInArrow(keep, docs.schema)
