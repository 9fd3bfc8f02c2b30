"""Byte-level BPE encoding and decoding (operator 2).

Texts are cut into overlapping chunks that are pre-tokenised in parallel.  A
pre-token depends only on the text from its start on, so two runs that share
one boundary share all later ones: neighbouring chunks are stitched at the
first common boundary in their overlap, and only then are the pieces encoded,
each on its own, by the ranks of a public vocabulary.  Where an overlap has no
common boundary (one very long run), the text is pre-tokenised again from the
last certain boundary.  Decoding concatenates the raw bytes of the ids.

A text of one chunk needs no stitching and is encoded where it was read;
chunks of longer texts are spread over all tasks, where the boundaries in
their overlaps are found, and meet again by row.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CHUNK, OVERLAP = 16_384, 512        # characters
_LOOK = 3                           # a match may depend on so many characters behind its end
_STEP = 1 << 16                     # ids decoded or written at a time
_PATTERN = regex.compile(public_tokenizers.PATTERN)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """Encoder and decoder of one rank file; made once per task."""

    def __init__(self, path: str | None = None):
        ranks = load_ranks(path or public_tokenizers.path(VOCABULARY))
        self._encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        by_id = {i: b for b, i in ranks.items()}
        self._size = np.array([len(by_id.get(i, b"")) for i in range(max(by_id) + 1)], dtype=np.int64)
        self._at = np.cumsum(self._size) - self._size
        self._raw = np.frombuffer(b"".join(by_id[i] for i in sorted(by_id)), dtype=np.uint8)

    def encode(self, text: str) -> np.ndarray:
        """Ids of the pre-tokens of a text, each encoded separately."""
        return np.array(self._encoding.encode_ordinary(text) if text else [], dtype=np.int32)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Raw bytes of the id lists ``ids[offsets[i]:offsets[i + 1]]``; an id
        outside the vocabulary is an error."""
        if ids.size and (ids.min() < 0 or ids.max() >= self._size.size or not self._size[ids].all()):
            raise ValueError("id outside the vocabulary")
        end = np.concatenate(([0], np.cumsum(self._size[ids])))
        raw = np.empty(end[-1], dtype=np.uint8)
        for k in range(0, ids.size, _STEP):
            part = ids[k:k + _STEP]
            to = end[k:k + part.size + 1] - end[k]
            raw[end[k]:end[k + part.size]] = self._raw[np.repeat(self._at[part] - to[:-1], np.diff(to)) + np.arange(to[-1])]
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(end[offsets].astype(np.int32)), pa.py_buffer(raw)])


def pre_tokens(text: str) -> list[str]:
    return _PATTERN.findall(text)


def chunks(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Overlapping chunks: number k starts at ``k * size``."""
    return [text[i:i + size + overlap] for i in range(0, max(1, len(text)), size)]


def boundaries(text: str, lo: int, hi: int) -> list[int]:
    """Where a pre-token of ``text`` ends between ``lo`` and ``hi`` that more text
    behind would not change, and whose last character is no white space: a text
    cut there gives the same pre-tokens on both sides as uncut."""
    pieces = pre_tokens(text)
    ends = np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))).tolist()
    hi = min(hi, len(text) - _LOOK)
    return [e for e, p in zip(ends, pieces) if lo <= e <= hi and not p[-1].isspace()]


class Stitcher:
    """Joins consecutive chunks of one text: ``add`` takes a chunk and its
    boundaries in its head and tail overlap (offsets in the chunk) and returns
    the span that is now certain; ``rest`` is the last span."""

    def __init__(self, size: int = CHUNK, overlap: int = OVERLAP):
        self.size, self.overlap, self.k = size, overlap, 0
        self.text, self.start, self.tail = "", 0, set()

    def add(self, text: str, head: list[int], tail: list[int]) -> str:
        at, self.k = self.k * self.size, self.k + 1
        if at == 0:
            self.text, self.tail = text, {x for x in tail}
            return ""
        both = self.tail.intersection(at + x for x in head)
        if both:
            cut = min(both)
            out = self.text[:cut - self.start]
            self.text, self.start = text[cut - at:], cut
            self.tail = {at + x for x in tail}
            return out
        # no common boundary: the certain start holds on, over both chunks
        self.text = self.text[:at - self.start] + text
        zone = at + self.size - self.start
        self.tail = {self.start + x for x in boundaries(self.text, zone, zone + self.overlap)}
        return ""

    def rest(self) -> str:
        return self.text


# What an encoding pass can return per document, all from the same ids.
OUTPUTS = {"ids": "array<int>", "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}


def ids_digest(ids: np.ndarray) -> str:
    """SHA-256 of the decimal ids joined by commas."""
    h = hashlib.sha256()
    for k in range(0, len(ids), _STEP):
        h.update(("," * (k > 0) + ",".join(map(str, ids[k:k + _STEP].tolist()))).encode())
    return h.hexdigest()


def _batch(codec: Codec, doc_ids: list, ids: list[np.ndarray], outputs: tuple[str, ...]) -> pa.RecordBatch:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
    values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    made = {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))}
    if {"decoded", "decoded_sha256"} & set(outputs):
        made["decoded"] = codec.decode(values, offsets)
    if "ids_sha256" in outputs:
        made["ids_sha256"] = pa.array([ids_digest(x) for x in ids], pa.string())
    if "decoded_sha256" in outputs:
        made["decoded_sha256"] = pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in made["decoded"]], pa.string())
    return pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(np.diff(offsets).astype(np.int64)), *(made[k] for k in outputs)],
                                      names=["doc_id", "n_tokens", *outputs])


def _parts(batch: pa.RecordBatch, rows: int = 100):
    """Slices of a batch, so that the ids of few texts are held at once."""
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
            size: int = CHUNK, overlap: int = OVERLAP, outputs: tuple[str, ...] = ("ids",)) -> DataFrame:
    """``doc_id, n_tokens`` and ``outputs`` for every document; ``path`` names a
    rank file that every executor can read (None: the installed public
    vocabulary).  ``decoded`` holds the raw bytes of the ids, decoded where they
    were made; the digests are those of the ids (decimal, joined by commas) and
    of the decoded bytes.

    Null and empty texts have no ids; null and repeated ids keep one row per
    document; an empty table gives no rows; other columns are ignored."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    long = F.coalesce(F.char_length("text") > size, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in chain.from_iterable(map(_parts, batches)):
            yield _batch(codec, b.column("doc_id").to_pylist(), [codec.encode(t) for t in b.column("text").to_pylist()], outputs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chain.from_iterable(map(lambda x: _parts(x, 10), batches)):
            rows = [(r, i, k, c) for r, i, t in zip(*(b.column(x).to_pylist() for x in ("rid", "doc_id", "text")))
                    for k, c in enumerate(chunks(t, size, overlap))]
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], kind) for j, kind in
                                              enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))],
                                             names=["rid", "doc_id", "chunk", "text"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, tails = [], []
            for t in b.column("text"):
                found = boundaries(x := t.as_py(), 0, len(x))
                heads.append([e for e in found if e <= overlap])
                tails.append([e for e in found if size <= e <= size + overlap])
            for name, lists in (("head", heads), ("tail", tails)):
                b = b.append_column(name, pa.array(lists, pa.list_(pa.int32())))
            yield b

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, at, doc, stitcher, ids = Codec(path), None, None, None, []
        for b in chain.from_iterable(map(lambda x: _parts(x, 20), batches)):
            done = []
            for rid, doc_id, text, head, tail in zip(*(b.column(x).to_pylist() for x in ("rid", "doc_id", "text", "head", "tail"))):
                if rid != at:
                    if at is not None:
                        done.append((doc, np.concatenate(ids + [codec.encode(stitcher.rest())])))
                    at, doc, stitcher, ids = rid, doc_id, Stitcher(size, overlap), []
                ids.append(codec.encode(stitcher.add(text, head, tail)))
            yield _batch(codec, [x for x, _ in done], [x for _, x in done], outputs)
        if at is not None:
            yield _batch(codec, [doc], [np.concatenate(ids + [codec.encode(stitcher.rest())])], outputs)

    kind = "rid long, doc_id long, chunk long, text string"
    out = ", ".join(["doc_id long", "n_tokens long", *(f"{k} {OUTPUTS[k]}" for k in outputs)])
    stitched = (d.select(F.monotonically_increasing_id().alias("rid"), "*").where(long).mapInArrow(cut, kind)
                .repartition("rid", "chunk").mapInArrow(split, kind + ", head array<int>, tail array<int>")
                .repartition("rid").sortWithinPartitions("rid", "chunk").mapInArrow(stitch, out))
    return d.where(~long).mapInArrow(whole, out).unionByName(stitched)


def decoded(tokens: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``, the raw bytes of its ids (null or no ids: no bytes)."""
    prepare(tokens.sparkSession)
    names = [c for c in tokens.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for b in chain.from_iterable(map(_parts, batches)):
            lists = b.column(ids_col)
            sizes = np.concatenate(([0], np.array([n or 0 for n in pc.list_value_length(lists).to_pylist()], dtype=np.int64)))
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            yield b.select(names).append_column("decoded", codec.decode(ids, np.cumsum(sizes)))

    kept = tokens.select(*names)
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(docs: DataFrame, path: str | None = None, keep_ids: bool = False, **options) -> DataFrame:
    """Every document encoded and decoded: digests of the ids and of the decoded
    bytes (and the ids)."""
    return encoded(docs, path, outputs=("ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])), **options)
