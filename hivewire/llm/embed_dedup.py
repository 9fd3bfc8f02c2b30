"""Embedding near-duplicates by Euclidean p-stable hashing (operator 5).

Vectors are normalised; ``TABLES`` tables of ``K`` random projections,
quantised with width ``WIDTH``, give bucket keys.  Pairs that share a bucket
are checked by exact cosine in double precision.  With the constants below a
pair at the threshold is missed by all tables with probability 2e-5, closer
pairs far less often.

Equal vectors of a label collapse to one weighted vertex.  Buckets are counted
by their keys alone; those of one vertex, and those with the members of an
earlier one, are dropped before any vector moves.
A bucket of more than ``BLOCK`` vertices is dealt to pairs of blocks, and a
vector travels once per block it is in.  Inside a group cosines are a matrix
product; a pair counts in the first table where it meets (both rows carry all
their keys), so nothing but a count and one link per member leaves the task.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, join_unique, mix64, prepare, seeds, small, written

COSINE = 0.93
TABLES, K, WIDTH = 144, 16, 2.0
BLOCK = 1_024

_BASE = "rid long, vec_id long, label string, gk binary, vec binary, sig array<int>"


def projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1000 + dim)
    return rng.standard_normal((dim, TABLES * K)), rng.uniform(0, WIDTH, TABLES * K)


def keys(x: np.ndarray) -> np.ndarray:
    """One 32-bit bucket key per table for normalised rows."""
    p, b = projections(x.shape[1])
    q = np.floor((x @ p + b) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(x), TABLES, K)
    h = np.broadcast_to(seeds(TABLES, 5), q.shape[:2]).copy()
    for j in range(K):
        h = mix64(h ^ q[:, :, j]) + np.uint64(j)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _usable(v: list | None, label) -> bool:
    return bool(v) and label is not None and None not in v and bool(np.isfinite(v).all()) and any(v)


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vecs, labels = b.column("vec").to_pylist(), b.column("label").to_pylist()
        gk, raw, sig = [None] * len(vecs), [None] * len(vecs), [None] * len(vecs)
        by_dim: dict[int, list[int]] = {}
        for i, v in enumerate(vecs):
            if _usable(v, labels[i]):
                by_dim.setdefault(len(v), []).append(i)
        for rows in by_dim.values():
            x = np.array([vecs[i] for i in rows], dtype=np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)        # no overflow in the squares
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            s = keys(x)
            for i, row, k in zip(rows, x, s):
                gk[i] = hashlib.blake2b(f"{labels[i]}\0".encode() + row.tobytes(), digest_size=16).digest()
                raw[i], sig[i] = row.tobytes(), k
        yield pa.RecordBatch.from_arrays([
            b.column("rid"), b.column("vec_id"), b.column("label"), pa.array(gk, pa.binary()), pa.array(raw, pa.binary()),
            pa.array(sig, pa.list_(pa.int32()))], names=["rid", "vec_id", "label", "gk", "vec", "sig"])


def group_links(t: int, v: np.ndarray, w: np.ndarray, x: np.ndarray, sig: np.ndarray, left: int | None = None,
                least: float = COSINE) -> np.ndarray:
    """``(v, links, root)``, in columns, of the members of a block (``left`` None) or
    of two blocks (the first ``left`` rows and the rest) that are linked and meet
    in table ``t`` first.  ``w`` are weights, ``x`` vectors, ``sig`` bucket keys;
    ``links`` counts rows, ``root`` is the smallest member linked through."""
    if left is None:
        i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
    else:
        i, j = np.nonzero(x[:left] @ x[left:].T >= least)
        j = j + left
    if t and i.size:
        first = np.ones(i.size, dtype=bool)
        for at in range(0, i.size, 1 << 16):
            a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            first[at:at + (1 << 16)] = ~(sig[a, :t] == sig[b, :t]).any(axis=1)
        i, j = i[first], j[first]
    links = np.bincount(i, w[j], len(v)) + np.bincount(j, w[i], len(v))
    root = np.argsort(np.argsort(v, kind="stable"), kind="stable")
    while i.size:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        if (low == root).all():
            break
        root = low
    at = np.flatnonzero(links)
    return np.stack((v[at], links[at].astype(np.int64), np.sort(v)[root[at]]))


def _columns(b: pa.RecordBatch, a: int, z: int) -> tuple:
    """``sub, v, w``, vectors and keys of rows ``a`` to ``z`` (of one dimension), from the Arrow buffers."""
    vec = b.column("vec")
    off = np.frombuffer(vec.buffers()[1], np.int32, count=len(vec) + 1, offset=4 * vec.offset)
    x = np.frombuffer(vec.buffers()[2], np.float64, count=(int(off[z]) - int(off[a])) // 8, offset=int(off[a]))
    sig = b.column("sig").slice(a, z - a).flatten().to_numpy(zero_copy_only=False).reshape(z - a, -1)
    return *(b.column(c).to_numpy()[a:z] for c in ("sub", "v", "w")), x.reshape(z - a, -1), sig


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, bi, bj): a block or pair of blocks comes together."""
    at, held = None, []

    def close() -> np.ndarray:
        if sum(len(h[1]) for h in held) < 2:
            return np.zeros((3, 0), np.int64)
        sub, v, w, x, sig = (np.concatenate(c) for c in zip(*held))
        if at[1] == at[2]:
            return group_links(at[3], v, w, x, sig)
        order = np.argsort(sub != at[1], kind="stable")
        return group_links(at[3], v[order], w[order], x[order], sig[order], int((sub == at[1]).sum()))

    def batch(found: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(found, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["v", "links", "root"])

    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([b.column(c).to_numpy() for c in ("bucket", "bi", "bj", "t")])
        cut = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
        out = [np.zeros((3, 0), np.int64)]
        for a, z in zip(cut[:-1], cut[1:]):
            here = tuple(key[:, a].tolist())
            if here != at:
                out.append(close())
                at, held = here, []
            held.append(_columns(b, a, z))
        yield batch(out)
    yield batch([close()])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector.

    Only vectors with equal, non-null labels (and equal dimension) are compared.
    Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing and are their own component.  Equal vectors link; a null
    id never becomes a component's id unless all its ids are null; repeated ids
    are rows of their own.  An empty table gives no rows; other columns are
    ignored."""
    prepare(vectors.sparkSession)
    d = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"),
                       F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    base = written(d.mapInArrow(_base, _BASE), "vectors")
    reps = written(base.where("gk IS NOT NULL").groupBy("gk").agg(F.min("rid").alias("v"), F.min("vec_id").alias("min_id"),
                                                                 F.count(F.lit(1)).alias("w")), "vertices")
    rows = written(base.join(reps.select(F.col("v").alias("rid"), "w"), "rid").select(
        F.col("rid").alias("v"), "w", F.concat("label", F.lit("\0"), F.octet_length("vec").cast("string")).alias("group"), "vec", "sig"), "reps")
    keyed = rows.select("v", "group", F.posexplode("sig").alias("t", "key"))
    # only keys are counted: a bucket of one vertex has nothing to compare, and of
    # buckets with the same members the one of the first table does
    shared = keyed.groupBy("group", "t", "key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("v")).alias("s1"),
                                                    F.bit_xor(F.xxhash64(F.lit(5), "v")).alias("s2")).where("n > 1")
    shared = shared.groupBy("n", "s1", "s2").agg(F.min(F.struct("t", "group", "key")).alias("k"))
    shared = written(shared.select(F.monotonically_increasing_id().alias("bucket"), "k.group", "k.t", "k.key",
                                   F.ceil(F.col("n") / BLOCK).alias("blocks")), "buckets")
    held = keyed.join(small(shared), ["group", "t", "key"]).select("bucket", F.col("t").cast("long").alias("t"), "v", "blocks")
    dealt = held.withColumn("sub", F.pmod(F.xxhash64("v"), F.col("blocks")))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = written(dealt.select("bucket", "t", F.least("sub", "o").alias("bi"), F.greatest("sub", "o").alias("bj"), "sub", "v"), "dealt")
    work = dealt.join(rows.select("v", "w", "vec", "sig"), "v")
    links = written(work.repartition("bucket", "bi", "bj").sortWithinPartitions("bucket", "bi", "bj")
                    .mapInArrow(_links, "v long, links long, root long"), "links")
    discard(dealt)
    comp = components(links.select(F.col("v").alias("a"), F.col("root").alias("b")))
    of_rep = written(reps.join(links.groupBy("v").agg(F.sum("links").alias("links")), "v", "left").join(comp, "v", "left").select(
        "gk", "min_id", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("comp", "v").alias("comp")), "of-rep")
    least = of_rep.groupBy("comp").agg(F.min("min_id").alias("component_id"))
    of_set = written(join_unique(of_rep, least, "comp").select("gk", "n_links", "component_id"), "of-set")
    got = join_unique(base.select("vec_id", "gk"), of_set, "gk")
    cid = F.when(F.col("gk").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return got.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), cid.alias("component_id"),
                      F.coalesce(F.col("vec_id") == cid, F.lit(False)).alias("kept"))
