"""Packed token-id output (operator 1).

Texts are encoded, overlong documents are cut losslessly into pieces of at most
``LENGTH`` ids, and pieces are packed best-fit-decreasing: the longest first,
each into the open row with the smallest sufficient residual capacity, found in
a segment tree over capacities.  A packed row has its padded ids, cumulative
segment lengths, and positions that restart at every segment.

Pieces are dealt evenly to buckets of about ``BUCKET_BYTES`` of text, and every
bucket is packed on its own: a bucket's size does not grow with the data, and at
most its last few rows are not full.
"""

from __future__ import annotations

import math
from collections import deque
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Codec
from .common import prepare

LENGTH = 2_048
PAD = 50_256                # free id of the vocabulary
BUCKET_BYTES = 8 << 20
_PIECES = "bucket int, doc_id long, piece int, n int, ids binary"
PACKED = ("bucket int, row int, n_tokens int, n_segments int, ids array<int>, cu_seqlens array<int>, "
          "position_ids array<int>, doc_ids array<long>, pieces array<int>")


class Capacities:
    """Open rows by residual capacity: a segment tree over 0 to ``length``."""

    def __init__(self, length: int):
        self.base = 1 << length.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: dict[int, deque[int]] = {}

    def add(self, capacity: int, row: int) -> None:
        self.rows.setdefault(capacity, deque()).append(row)
        self._bump(capacity, 1)

    def _bump(self, capacity: int, by: int) -> None:
        k = capacity + self.base
        while k:
            self.count[k] += by
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) with the smallest capacity of at least
        ``need``; the earliest opened row of that capacity."""
        k = need + self.base
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.base:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        capacity = k - self.base
        self._bump(capacity, -1)
        return capacity, self.rows[capacity].popleft()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indexes into ``sizes`` (each 1 to ``length``); equal sizes go in the order given."""
    open_, rows = Capacities(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        got = open_.take(sizes[i])
        if got is None:
            capacity, row = length, len(rows)
            rows.append([])
        else:
            capacity, row = got
        rows[row].append(i)
        if capacity > sizes[i]:
            open_.add(capacity - sizes[i], row)
    return rows


def _rows(bucket: int, pieces: list[tuple], length: int, pad: int) -> Iterator[pa.RecordBatch]:
    # (doc_id or none, piece, n, ids): the same order whatever order the shuffle gave
    pieces = sorted(pieces, key=lambda p: (p[0] is None, p[0] or 0, p[1], p[3]))
    ids = [np.frombuffer(raw, dtype=f"<u{len(raw) // n}") for _, _, n, raw in pieces]
    packed = best_fit_decreasing([x.size for x in ids], length)
    for at in range(0, len(packed), 200):
        out: dict[str, list] = {k.split()[0]: [] for k in PACKED.split(", ")}
        for n, members in enumerate(packed[at:at + 200], at):
            cu = np.concatenate(([0], np.cumsum([ids[i].size for i in members]))).astype(np.int32)
            row = np.full(length, pad, dtype=np.int32)
            row[:cu[-1]] = np.concatenate([ids[i] for i in members])
            ends = np.append(cu, length) if cu[-1] < length else cu
            position = np.arange(length, dtype=np.int32) - np.repeat(ends[:-1], np.diff(ends)).astype(np.int32)
            for k, x in zip(out, (bucket, n, int(cu[-1]), len(members), row, cu, position,
                                  [pieces[i][0] for i in members], [pieces[i][1] for i in members])):
                out[k].append(x)
        kinds = [pa.int32()] * 4 + [pa.list_(pa.int32())] * 3 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def packed(docs: DataFrame, length: int = LENGTH, pad: int = PAD, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Packed rows of all documents: ``bucket, row`` name a row; ``ids`` has
    ``length`` ids, the last ``length - n_tokens`` of them ``pad`` (positions
    restart there too); segment k is ``ids[cu_seqlens[k]:cu_seqlens[k + 1]]``,
    piece ``pieces[k]`` of document ``doc_ids[k]``.

    Null and empty texts have no ids and no segment; null and repeated ids keep
    one piece list per row; an empty table gives no rows; other columns are
    ignored.  The deal to buckets follows the table's own row order."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = d.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, turn = Codec(path), None
        width = "<u2" if codec.size <= 1 << 16 else "<u4"
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                b, out = whole.slice(at, 100), []
                for doc_id, text, task in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "task"))):
                    ids = codec.encode(text).astype(width) if text else ()
                    # every task starts at a bucket of its own and deals in turn
                    turn = task * 7919 if turn is None else turn
                    for k in range(0, len(ids), length):
                        part = ids[k:k + length]
                        out.append((turn % buckets, doc_id, k // length, len(part), part.tobytes()))
                        turn += 1
                kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in out], t) for j, t in enumerate(kinds)],
                                                 names=["bucket", "doc_id", "piece", "n", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for b in batches:
            for bucket, *rest in zip(*(b.column(c).to_pylist() for c in ("bucket", "doc_id", "piece", "n", "ids"))):
                if bucket != at:
                    if held:
                        yield from _rows(at, held, length, pad)
                    at, held = bucket, []
                held.append(tuple(rest))
        if held:
            yield from _rows(at, held, length, pad)

    return (d.withColumn("task", F.spark_partition_id()).mapInArrow(cut, _PIECES).repartition("bucket")
            .sortWithinPartitions("bucket").mapInArrow(pack, PACKED))


def write_packed(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write the packed rows as Parquet under ``path`` and return them read back."""
    packed(docs, **options).write.parquet(path)
    return docs.sparkSession.read.parquet(path)
