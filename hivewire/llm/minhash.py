"""MinHash near-duplicates by fast similarity sketching (operator 10).

Sketch: ``T`` coordinates per shingle set.  Round i < T throws every shingle
into one hashed bin; a coordinate keeps its smallest (round, hash) value.  A
set stops when all its bins are filled; round T + j throws all shingles of a
set into bin j, so every coordinate is filled after at most 2T rounds.  Two
sets agree in a coordinate with probability equal to their Jaccard similarity,
with the concentration of independent samples.

Plan: equal sets collapse to one vertex; 24 bands of 5 coordinates bucket the
vertices; in every bucket the members are verified on full shingle sets
against the bucket's smallest vertex (a star, not all pairs).  Buckets whose
members are then still in several components go through a second pass that
verifies the pairs across components in blocks.  Only ids and band keys are
shuffled per band; texts travel compressed, once per verified pair or block,
and intermediates are deleted once nothing reads them any more.
"""

from __future__ import annotations

import hashlib
from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, join_unique, mix64, prepare, seeds, shingle_sets, small, unused, written

T, ROWS = 120, 5          # coordinates, coordinates per band (24 bands)
PERCENT = 85              # links: 100 * intersection >= PERCENT * union, unless the caller says otherwise
CHUNK = 200               # members verified against one copy of their leader
BLOCK = 200               # vertices per side of a block in the second pass


def sketch(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """Fast similarity sketches, one row of ``t`` coordinates per set (no set empty)."""
    n = len(sets)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = np.uint64(0xFFFFFFFF)
    out = np.full(n * t, empty)
    a = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    d = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    seed = seeds(2 * t, 10)
    for i in range(2 * t):
        if not a.size:
            break
        h = mix64(a ^ seed[i])
        if i < t:
            b = d * t + (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
        else:
            b = d * t + (i - t)
        np.minimum.at(out, b, (h & low) | np.uint64(i << 32))
        live = np.unique(d)
        done = np.zeros(n, dtype=bool)
        done[live] = (out.reshape(n, t)[live] != empty).all(axis=1)
        left = ~done[d]
        a, d = a[left], d[left]
    return out.reshape(n, t)


def band_keys(sk: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of the key."""
    bands = sk.shape[1] // rows
    seed = seeds(bands, 11)
    out = np.empty((sk.shape[0], bands), dtype=np.uint64)
    for j in range(bands):
        h = np.full(sk.shape[0], seed[j])
        for r in range(rows):
            h = mix64(h ^ sk[:, j * rows + r])
        out[:, j] = h
    return out


BASE = "rid long, doc_id long, th long, n_shingles long, set_key binary, bands array<long>"


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = shingle_sets(b.column("text").to_pylist())
        full = [s for s in sets if s.size]
        keys = iter(band_keys(sketch(full)).view(np.int64))
        yield pa.RecordBatch.from_arrays([
            b.column("rid"), b.column("doc_id"), b.column("th"),
            pa.array([s.size for s in sets], pa.int64()),
            pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if s.size else None for s in sets], pa.binary()),
            pa.array([next(keys) if s.size else None for s in sets], pa.list_(pa.int64())),
        ], names=["rid", "doc_id", "th", "n_shingles", "set_key", "bands"])


def linked(inter: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * inter >= percent * (a + b - inter)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate((a, b))
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _unpacked(b: pa.RecordBatch) -> list[np.ndarray]:
    """Shingle sets of a batch's compressed texts."""
    z = zstandard.ZstdDecompressor()
    return shingle_sets([z.decompress(t) for t in b.column("text").to_pylist()])


def _verify_stars(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (leader, chunk, kind): the leader's text, then members."""
    head, at = None, None
    for b in batches:
        ea, eb = [], []
        sets = _unpacked(b)
        for leader, chunk, kind, v, s in zip(*(b.column(c).to_pylist() for c in ("leader", "chunk", "kind", "v")), sets):
            if kind == 0:
                if at != (leader, chunk):
                    head, at = s, (leader, chunk)
                continue
            if 100 * min(s.size, head.size) >= percent * max(s.size, head.size) and linked(_common(s, head), s.size, head.size, percent):
                ea.append(leader)
                eb.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(ea, pa.int64()), pa.array(eb, pa.int64())], names=["a", "b"])


class _Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            self[x] = self[self[x]]
            x = self[x]
        return x


def block_links(left: list, right: list | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Spanning links between the vertices ``(v, comp, set)`` of a block
    (``right`` None) or of two blocks, across components only.  An inverted
    index over the larger side counts intersections; pairs that earlier links
    joined are skipped."""
    other = left if right is None else right
    uf, out = _Union(), []
    flat = np.concatenate([s for _, _, s in other])
    owner = np.repeat(np.arange(len(other)), [s.size for _, _, s in other])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    sizes = np.array([s.size for _, _, s in other])
    for i, (v, comp, s) in enumerate(left):
        lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        n = hi - lo
        if not n.sum():
            continue
        first = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
        inter = np.bincount(owner[first + np.arange(n.sum())], minlength=len(other))
        for j in np.nonzero(100 * inter >= percent * (sizes + s.size - inter))[0]:
            w, comp_w, _ = other[j]
            if (right is None and j <= i) or uf.find(comp) == uf.find(comp_w):
                continue
            uf[uf.find(comp)] = uf.find(comp_w)
            out.append((v, w))
    return out


def _verify_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bkey, bi, bj): all vertices of a block pair come together."""
    at, left, right = None, {}, {}

    def close():
        if not left or (at and at[1] != at[2] and not right):
            return []
        return block_links(list(left.values()), None if at[1] == at[2] else list(right.values()), percent)

    for b in batches:
        found = []
        sets = _unpacked(b)
        for bkey, bi, bj, sub, v, comp, s in zip(*(b.column(c).to_pylist()
                                                   for c in ("bkey", "bi", "bj", "sub", "v", "comp")), sets):
            if at != (bkey, bi, bj):
                found += close()
                at, left, right = (bkey, bi, bj), {}, {}
            (left if sub == bi else right)[v] = (v, comp, s)
        yield _edges(found)
    yield _edges(close())


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()),
                                       pa.array([y for _, y in found], pa.int64())], names=["a", "b"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("v"), pa.array([z.compress(t) for t in b.column("text").to_pylist()], pa.binary())],
                                         names=["v", "text"])


def _texts(docs: DataFrame, need: DataFrame, keys: DataFrame) -> DataFrame:
    """``(v, text)`` (compressed) of the vertices ``need(v, doc_id, th)``; ``keys``
    are those of all rows."""
    d = docs.select(F.col("doc_id").alias("_id"), F.col("text"), F.xxhash64("text").alias("th"))
    k = small(need.withColumnRenamed("doc_id", "_doc"))
    got = d.join(k, (d["th"] == k["th"]) & d["_id"].eqNullSafe(k["_doc"])).select("v", F.col("text").cast("binary").alias("text"))
    packed = got.mapInArrow(_packed, "v long, text binary")
    # rows that repeat id and text would each give their vertex's text
    once = keys.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    return packed if once else packed.dropDuplicates(["v"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept`` and
    ``rid, th, first`` (row number, text hash, and whether the row is the one
    that stays when repeated ids are told apart).  Documents link from ``percent``
    hundredths of Jaccard similarity on (the bands miss a pair at 0.85 with
    8e-7, at 0.8 with 7e-5).

    Null, empty and blank texts have no shingles and link with nothing; they
    are their own component.  Equal texts link, also under a null or repeated
    id; null ids never become a component's id unless all are null (then it is
    null).  An empty table gives no rows; other columns are ignored."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = written(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("text").alias("th"),
                               F.col("text").cast("binary").alias("text")).mapInArrow(_base, BASE), "base")
    sets = base.where("n_shingles > 0")
    reps = written(sets.groupBy("set_key").agg(F.min("rid").alias("v"), F.min("doc_id").alias("min_doc")), "reps")
    rows = written(sets.join(reps.select(F.col("v").alias("rid")), "rid", "left_semi")
                   .select(F.col("rid").alias("v"), F.explode("bands").alias("bkey")), "bands")
    buckets = written(rows.groupBy("bkey").agg(F.min("v").alias("leader"), F.count(F.lit(1)).alias("n"),
                                               F.bit_xor(F.xxhash64("v")).alias("s1"),
                                               F.bit_xor(F.xxhash64(F.col("v") + 1)).alias("s2")).where("n > 1"), "buckets")
    held = written(join_unique(rows, buckets.drop("n", "s1", "s2"), "bkey", "inner", buckets.select("bkey", "n"))
                   .select("bkey", "v", "leader"), "held")
    discard(rows)
    pairs = written(held.where("v <> leader").select("leader", "v").distinct(), "pairs")
    keys = base.select(F.col("rid").alias("v"), "doc_id", "th")
    named = pairs.select("v").unionByName(pairs.select(F.col("leader").alias("v"))).distinct()
    named = written(keys.join(named, "v", "left_semi"), "named")
    texts = written(_texts(docs, named, keys), "texts")
    edges = written(_star_edges(pairs, texts, percent), "links")
    comp = components(edges)
    edges2 = _second_pass(held, buckets, comp, texts, percent)
    discard(held, texts, named)
    if edges2 is not None:
        comp = components(edges.unionByName(edges2))
    of_rep = written(reps.join(comp, "v", "left").select("set_key", "min_doc", F.coalesce("comp", "v").alias("comp"), "v"), "reps2")
    least = of_rep.groupBy("comp").agg(F.min("min_doc").alias("component_id"), F.min("v").alias("_v"))
    of_set = written(join_unique(of_rep.select("set_key", "comp"), least, "comp"), "sets")
    got = join_unique(base.select("rid", "doc_id", "th", "n_shingles", "set_key"), of_set, "set_key")
    single = F.col("set_key").isNull()
    cid = F.when(single, F.col("doc_id")).otherwise(F.col("component_id"))
    return got.select("doc_id", "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, F.lit(False)).alias("kept"), "rid", "th",
                      F.when(single, F.col("rid")).otherwise(F.col("comp")).alias("comp"))


def _star_edges(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Verified links between leaders and members.  A leader's members are dealt
    to chunks of about ``CHUNK``, each with its own copy of the leader's text."""
    size = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    size = written(size, "chunks")
    chunked = join_unique(pairs, size, "leader").select(
        "leader", F.pmod(F.xxhash64("v"), F.col("chunks")).alias("chunk"), F.lit(1).alias("kind"), "v")
    heads = size.select("leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
                        F.lit(0).alias("kind"), F.col("leader").alias("v"))
    work = written(chunked.unionByName(heads), "work").join(texts, "v")
    return (work.select("leader", "chunk", "kind", "v", "text").repartition("leader", "chunk")
            .sortWithinPartitions("leader", "chunk", "kind").mapInArrow(partial(_verify_stars, percent=percent), "a long, b long"))


def _second_pass(held: DataFrame, buckets: DataFrame, comp: DataFrame, texts: DataFrame, percent: int) -> DataFrame | None:
    """Links across components inside buckets that the stars left apart (None
    if there are no such buckets).  Buckets with the same members count once;
    a bucket of more than ``BLOCK`` vertices is dealt to block pairs."""
    c = written(join_unique(held.select("bkey", "v"), comp, "v").select("bkey", "v", F.coalesce("comp", "v").alias("comp")),
                "held2")
    apart = (c.groupBy("bkey").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bkey"))
    # two vertices: leader and member were verified against each other already
    open_ = written(buckets.where("n > 2").join(apart, "bkey", "left_semi").groupBy("n", "s1", "s2")
                    .agg(F.min("bkey").alias("bkey")).select("bkey", F.ceil(F.col("n") / BLOCK).alias("blocks")), "open")
    if open_.isEmpty():
        return None
    rows = written(join_unique(c, open_, "bkey", "inner")
                   .withColumn("sub", F.pmod(F.xxhash64("v"), F.col("blocks"))), "open-rows")
    other = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    work = rows.select("bkey", "v", "comp", "sub", F.explode(other).alias("o")).select(
        "bkey", F.least("sub", "o").alias("bi"), F.greatest("sub", "o").alias("bj"), "sub", "v", "comp")
    found = (work.join(texts, "v").repartition("bkey", "bi", "bj").sortWithinPartitions("bkey", "bi", "bj")
             .mapInArrow(partial(_verify_blocks, percent=percent), "a long, b long"))
    return written(found, "links2")


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` (all its columns) with one document of each group: the smallest
    id; a null id only stays when the group has no other, and of repeated rows
    one stays.  Rows are matched by id and text hash, so any table of
    documents with repeated or null ids keeps its meaning."""
    got = written(near_duplicates(docs, percent=percent), "dedup")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    stay = got.groupBy("comp").agg(F.min(order).alias("m")).select(F.col("m.rid").alias("rid"))
    keep = written(got.join(stay, "rid", "left_semi").select("doc_id", "th"), "stay")
    out = _with_keys(docs, keep)
    twice = written(got.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "th"), "twice")
    if twice.isEmpty():
        return out
    again = _with_keys(out, twice).dropDuplicates(["doc_id", "text"])
    return _with_keys(out, twice, "left_anti").unionByName(again)


def _with_keys(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    a, b = unused(docs, "key_id"), unused(docs, "key_th")
    k = small(keys.select(F.col("doc_id").alias(a), F.col("th").alias(b)))
    cond = docs["doc_id"].cast("long").eqNullSafe(k[a]) & (F.xxhash64(docs["text"].cast("string")) == k[b])
    return docs.join(k, cond, how)
