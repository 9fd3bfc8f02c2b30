"""Helpers shared by the training-data operators: written intermediates,
joins that split hot keys, connected components, word shingles and 64-bit
hashing."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_defaults, ensure_checkpoint_dir, scratch_path, ship_package

# Rows and bytes of one Arrow batch: what a Python worker holds at once.
ARROW_ROWS, ARROW_BYTES = "500", "4m"
# A side is broadcast by hint only up to this many (short, fixed-width) rows.
BROADCAST_ROWS = 500_000
# A key is hot above a thousandth of all rows, but not below HOT_ROWS and always
# above HOT_MOST rows (short rows: some hundred MB at most in a task).
HOT_ROWS, HOT_SHARE, HOT_MOST = 100_000, 1_000, 2_000_000


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings that every operator relies on."""
    apply_defaults(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it
    back: lineage is cut on storage that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` gave, once all that reads them is written."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``BROADCAST_ROWS`` rows
    (short rows: a few MB); beyond that Spark shuffles both sides."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "left", counts: DataFrame | None = None,
                fixed: bool = True) -> DataFrame:
    """Join a written ``left`` with ``right`` (one row per ``key``) so that no
    key of ``left`` meets in one task: the ``right`` rows of keys with over
    ``HOT_MOST`` rows, or a thousandth of all and ``HOT_ROWS``, are split off
    and broadcast (a thousand of them, or one for every ``HOT_MOST`` rows; by
    hint only behind their count); the other keys shuffle.  ``counts(key, n)``
    is taken where the caller has it.  Null keys match nothing and are not
    shuffled.  A ``right`` of ``fixed`` width and at most ``BROADCAST_ROWS`` rows is
    broadcast whole, so nothing is shuffled."""
    total = left.count()
    if total <= HOT_ROWS:
        return left.join(right, key, how)
    if fixed and right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), key, how)
    if counts is None:
        counts = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bound = min(HOT_MOST, max(HOT_ROWS, total // HOT_SHARE))
    hot = written(counts.where(F.col("n") > bound).select(key), "hot")
    out, rest = [], left.where(F.col(key).isNotNull())
    if how == "left":
        out.append(left.where(F.col(key).isNull()))
    if not hot.isEmpty():
        hot = small(hot)
        out.append(rest.join(hot, key, "left_semi").join(small(written(right.join(hot, key, "left_semi"), "hot-rows")), key, how))
        rest = rest.join(hot, key, "left_anti")
    whole = rest.join(right, key, how)
    for part in out:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): ``(v, comp)`` for every
    vertex that an edge names, ``comp`` the smallest vertex of its component.

    Each round hooks a vertex to its smallest lower neighbour (a grouped
    minimum), halves the paths until they end in roots, and contracts the
    edges to the roots; edges that remain go into the next round."""
    e = written(edges.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                .distinct(), "edges")
    labels = None
    while not e.isEmpty():
        p = written(e.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("p"))
                    .unionByName(e.select(F.col("lo").alias("v"), F.col("lo").alias("p")).distinct())
                    .groupBy("v").agg(F.min("p").alias("p")), "hooks")
        while True:
            up = p.select(F.col("v").alias("p"), F.col("p").alias("up"))
            q = written(join_unique(p, up, "p").select("v", F.col("up").alias("p"), (F.col("up") < F.col("p")).alias("moved")),
                        "paths")
            moved = not q.where("moved").isEmpty()
            p = q.select("v", "p")
            if not moved:
                break
        if labels is None:
            labels = p.select("v", F.col("p").alias("comp"))
        else:
            step = p.select(F.col("v").alias("comp"), F.col("p").alias("_root"))
            labels = written(join_unique(labels, step, "comp").select("v", F.coalesce("_root", "comp").alias("comp")),
                             "labels")
        a = written(join_unique(e, p.select(F.col("v").alias("lo"), F.col("p").alias("ra")), "lo").select("hi", "ra"), "ends")
        b = join_unique(a, p.select(F.col("v").alias("hi"), F.col("p").alias("rb")), "hi")
        e = written(b.where("ra <> rb").select(F.least("ra", "rb").alias("lo"), F.greatest("ra", "rb").alias("hi"))
                    .distinct(), "edges")
    if labels is None:
        return e.select(F.col("lo").alias("v"), F.col("lo").alias("comp"))
    return labels


# --- hashing -------------------------------------------------------------------

def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift, multiply), element by element."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed 64-bit seeds."""
    return np.array([xxhash.xxh3_64_intdigest(f"{salt}:{i}") for i in range(n)], dtype=np.uint64)


_PIECE = 1 << 20
_BYTE = seeds(256, 1)                                   # one random number per byte value
_X = np.uint64(0x9E3779B97F4A7C15 | 1)                  # odd, so it has an inverse modulo 2**64
_X_INV = np.uint64(pow(int(_X), -1, 1 << 64))
_SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])


def _powers(x: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, x, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW, _POW_INV = _powers(_X, _PIECE + 1), _powers(_X_INV, _PIECE + 1)


def word_hashes(buf: bytes, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the words ``[^\\x20\\x09-\\x0D]+`` of
    ``buf`` with A-Z lower-cased: differences of prefix sums of byte value
    times power, computed over pieces of about a megabyte."""
    b = np.frombuffer(buf.lower(), dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space[b], [True])).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    out = np.empty(starts.size, dtype=np.uint64)
    i = 0
    while i < starts.size:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _PIECE, "right")))
        at, n = starts[i], ends[j - 1] - starts[i]
        pw, inv = (_POW, _POW_INV) if n <= _PIECE else (_powers(_X, n + 1), _powers(_X_INV, n + 1))
        p = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[b[at:at + n]] * pw[:n], dtype=np.uint64)))
        s, e = starts[i:j] - at, ends[i:j] - at
        out[i:j] = mix64((p[e] - p[s]) * inv[s] ^ (e - s).astype(np.uint64))
        i = j
    return out, starts


def shingle_hashes(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of every run of ``k`` words; of the whole sequence if it is shorter."""
    n = h.size
    if n == 0:
        return h
    width = min(k, n)
    out = np.full(n - width + 1, width, dtype=np.uint64)
    for j in range(width):
        out = mix64(out ^ h[j:n - width + 1 + j]) + np.uint64(j + 1)
    return out


def shingle_sets(texts: list[bytes | None], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of every text; words are hashed
    over runs of texts of about four pieces."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or b"") <= 4 * _PIECE):
            size += len(texts[j] or b"")
            j += 1
        part = [t or b"" for t in texts[i:j]]
        h, starts = word_hashes(b" ".join(part))
        ends = np.cumsum([len(t) + 1 for t in part])
        cut = np.concatenate(([0], np.searchsorted(starts, ends)))
        runs = shingle_hashes(h, k) if h.size >= k else None
        for a, b in zip(cut[:-1], cut[1:]):
            s = runs[a:b - k + 1].copy() if b - a >= k else shingle_hashes(h[a:b], k)
            s.sort()
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))] if s.size else s)
        i = j
    return out
