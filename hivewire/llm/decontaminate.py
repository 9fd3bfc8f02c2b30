"""Benchmark decontamination by SimHash windows (operator 6).

Every benchmark item is represented by windows of its own size class, the
largest class that fits into it, from its first words and up to its last ones.
Windows of every class slide over the whole text in steps of ``STRIDE`` words,
and an item has a window for each of ``STRIDE`` shifts, so an item at any place
of a text meets one of its windows word for word (short items: steps of one).
Steps start at each text's own first word.  Smaller windows of every item, in
runs of ``STRIDE`` successive shifts, lie in whatever part of it is left when
words are missing at its ends, or between and beside one or two edits inside it:
a copy that is still similar enough with up to ``EDITS`` such edits, of any kind
and length, meets one word for word too, alone or inside other text.
The 64-bit SimHash of a window comes from prefix sums.  A multi-index over four 16-bit
blocks, each with all values one bit away, finds every fingerprint within
``RADIUS`` = 7 bits (of 8 differing bits at most one block can have two or
more without another having one or none).  Candidates are then verified
exactly: weighted Jaccard similarity (weights: occurrences) of the five-word
shingles of the item and of the item-sized window around the match, or of that
window or a wider one cut to the item's first and last shingle in it.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, shingle_hashes, unused, word_hashes, written

SIMILARITY = 0.8
RADIUS, BLOCKS, BITS = 7, 4, 16
EDITS = 2                           # inner edits after which a similar copy is found for certain
MIN_WORDS = 5                       # shorter items have no five-word shingle and match nothing
MAX_WINDOW = 4_096                  # words of the largest size class
STRIDE, SHORT = 4, 11               # items under SHORT words are searched in steps of one
SEGMENT = 32_768                    # window starts handled at a time
SLICE_BYTES = 16 << 20              # benchmark text that one pass holds in a task

# Words are runs of ASCII letters and digits and of all bytes beyond ASCII.
_BREAK = np.array([not (c >= 128 or chr(c).isalnum()) for c in range(256)])


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, punctuation ignored, and
    where each text begins (and the last one ends)."""
    raw = [(t or "").lower().encode() for t in texts]
    h, at = word_hashes(b"\n".join(raw), _BREAK)
    return h, np.concatenate(([0], np.searchsorted(at, np.cumsum([len(x) + 1 for x in raw]))))


def size_class(n: int) -> int:
    """The largest class not above ``n``: multiples of ``STRIDE`` that grow by
    about a sixth."""
    c = 2 * STRIDE
    while (up := c + max(STRIDE, c // 6 // STRIDE * STRIDE)) <= min(n, MAX_WINDOW):
        c = up
    return c


def shortest_run(n: int, least: float) -> int:
    """Words of the shortest part of an item of ``n`` words that alone is similar enough."""
    return MIN_WORDS - 1 + max(1, math.ceil(least * (n - MIN_WORDS + 1) - 1e-9))


def part_windows(n: int, least: float) -> tuple[int, int, list[int]]:
    """Window size, step and shifts such that every run of ``shortest_run`` words of
    an item of ``n`` words holds a window at any place against the step."""
    run = shortest_run(n, least)
    if n < SHORT or run - STRIDE + 1 < 2 * STRIDE:
        return run, 1, list(range(n - run + 1))
    c = size_class(max(2 * STRIDE, run - max(STRIDE - 1, run // 3)))
    room = run - c - STRIDE + 2             # first shifts at which a run of STRIDE shifts fits
    shifts: set[int] = set()
    for first in range(0, n - run + 1, room):
        at = min(first + room - 1, n - c - STRIDE + 1)
        shifts.update(range(at, at + STRIDE))
    return c, STRIDE, sorted(shifts)


def inner_windows(n: int, least: float) -> list[tuple[int, int, list[int]]]:
    """Window sizes, steps and shifts such that a copy of an item of ``n`` words
    that is similar enough after one to ``EDITS`` inner edits holds one of the
    windows unedited.  ``k`` edits break ``4 k`` shingles beside those of the words
    they take and add at least as many, which bounds the words taken; the longest
    of the ``k + 1`` parts left has its share of the others."""
    out = []
    for k in range(1, EDITS + 1):
        taken = math.floor((1 - least) * (n - MIN_WORDS + 1) - (MIN_WORDS - 1) * k * (1 + least) + 1e-9)
        run = math.ceil((n - taken) / (k + 1))
        if taken < 0 or run < 3 * STRIDE:
            break
        if k == 1:              # the longest part is at one of the ends
            c = size_class(run - STRIDE + 1)
            out.append((c, STRIDE, sorted({*range(STRIDE), *range(n - c - STRIDE + 1, n - c + 1)})))
            continue
        c = size_class(max(2 * STRIDE, run - max(STRIDE - 1, run // 3)))
        room = run - c - STRIDE + 2
        first = {min(a + room - 1, n - c - STRIDE + 1) for a in range(0, n - run + 1, room)}
        out.append((c, STRIDE, sorted({a + i for a in first for i in range(STRIDE)})))
    return out


def prefix_sums(h: np.ndarray, step: int) -> np.ndarray:
    """Running counts of set bits of the words' hashes, every ``step`` words
    (16 bits hold a segment)."""
    n = h.size // step
    bits = np.unpackbits(np.ascontiguousarray(h[:n * step]).view(np.uint8).reshape(-1, 8), axis=1)
    each = bits[::step].copy()
    for j in range(1, step):
        each += bits[j::step]
    out = np.zeros((n + 1, 64), dtype=np.uint16)
    np.cumsum(each, axis=0, dtype=np.uint16, out=out[1:])
    return out


def fingerprints(sums: np.ndarray, size: int, step: int) -> np.ndarray:
    """SimHash of the windows of ``size`` words, in steps of ``step``: a bit is
    set if over half of the words set it."""
    k = size // step
    return np.packbits((sums[k:] - sums[:-k]) > size // 2, axis=1).view(np.uint64).ravel()


class Index:
    """Fingerprints of benchmark items by size class, with their multi-index."""

    def __init__(self, items: list[tuple[int, str]], least: float = SIMILARITY):
        self.items = []
        by_class: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
        for item_id, text in items:
            h = words([text])[0]
            if h.size < MIN_WORDS:
                continue
            i, stride = len(self.items), STRIDE if h.size >= SHORT else 1
            c = size_class(h.size - stride + 1)
            c = c if stride > 1 else h.size
            self.items.append((item_id, h.size, Counter(shingle_hashes(h).tolist())))
            last = h.size - c
            for c, stride, shifts in ((c, stride, {*range(stride), *range(last - stride + 1, last + 1)}),
                                      part_windows(h.size, least), *inner_windows(h.size, least)):
                fp = fingerprints(prefix_sums(h, 1), c, 1)
                by_class.setdefault((c, stride), set()).update((int(fp[back]), i, back) for back in shifts)
        self.classes = []
        for (c, stride), rows in sorted(by_class.items()):
            rows = sorted(rows, key=lambda r: r[1:])
            fp = np.array([f for f, _, _ in rows], dtype=np.uint64)
            near = np.concatenate(([0], 1 << np.arange(BITS))).astype(np.int64)
            part = fp.view(np.uint16).reshape(-1, BLOCKS).astype(np.int64)
            blocks = []
            for k in range(BLOCKS):
                value = (part[:, k, None] ^ near).ravel()
                order = np.argsort(value, kind="stable")
                offset = np.searchsorted(value[order], np.arange((1 << BITS) + 1))
                blocks.append((np.diff(offset) > 0, offset, order // near.size))
            self.classes.append((c, stride, fp, blocks, np.array([i for _, i, _ in rows]), np.array([x for _, _, x in rows])))

    def candidates(self, h: np.ndarray, doc: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, start of the item-sized window, item) of all fingerprints within
        the radius; ``h`` holds the words of several texts, ``doc`` their numbers
        (-1: no text's word); steps start at word 0."""
        found: set[tuple[int, int, int]] = set()
        if not self.classes:
            return found
        widest = max(c for c, *_ in self.classes)
        strides = {stride for _, stride, *_ in self.classes}
        for at in range(0, h.size, SEGMENT):
            sums = {step: prefix_sums(h[at:at + SEGMENT + widest], step) for step in strides}
            for c, stride, fp, blocks, item, back in self.classes:
                if sums[stride].shape[0] <= c // stride:
                    continue
                own = fingerprints(sums[stride], c, stride)[:SEGMENT // stride]
                part = own.view(np.uint16).reshape(-1, BLOCKS)
                near = blocks[0][0][part[:, 0]]
                for k in range(1, BLOCKS):
                    near |= blocks[k][0][part[:, k]]
                near = np.flatnonzero(near)
                first = at + near * stride
                near = near[(doc[first] >= 0) & (doc[first] == doc[first + c - 1])]
                for k, (_, offset, rows) in enumerate(blocks):
                    value = part[near, k]
                    lo = offset[value]
                    n = offset[value.astype(np.int64) + 1] - lo
                    row = rows[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                    pos = np.repeat(near, n)
                    ok = np.bitwise_count(own[pos] ^ fp[row]) <= RADIUS
                    pos, row = at + pos[ok] * stride, row[ok]
                    found.update(zip(doc[pos].tolist(), (pos - back[row]).tolist(), item[row].tolist()))
        return found

    def similarity(self, shingles: list[int], item: int) -> float:
        mine, theirs = self.items[item][2], Counter(shingles)
        common = sum(min(n, mine[k]) for k, n in theirs.items() if k in mine)
        return common / (sum(mine.values()) + len(shingles) - common)

    def best_at(self, run: list[int], at: int, item: int, least: float) -> tuple[float, int]:
        """Best (similarity, -start) of the windows of the text's shingles ``run`` around
        ``at``: the item-sized one, and that and a wider one cut to the item's shingles."""
        n, mine = self.items[item][1] - MIN_WORDS + 1, self.items[item][2]
        best = (self.similarity(run[at:max(at + 1, at + n)], item), -at)
        slack = math.ceil(n * (1 / least - 1))      # words that may be put in
        for a, b in ((at, at + n), (max(0, at - slack), at + n + slack)):
            hits = [i for i in range(a, min(b, len(run))) if run[i] in mine]
            if hits:
                best = max(best, (self.similarity(run[hits[0]:hits[-1] + 1], item), -hits[0]))
        return best

    def matches(self, texts: list[str | None], least: float = SIMILARITY) -> list[dict[int, tuple[float, int]]]:
        """Per text the best (similarity, -start word) per item of its verified matches."""
        best: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        for lo, hi in _runs(texts):
            h, doc, begin, end = _aligned(*words(texts[lo:hi]))
            runs: dict[int, list[int]] = {}
            for d, at, item in sorted(self.candidates(h, doc)):
                start = max(0, at - int(begin[d]))
                if d not in runs:
                    runs = {d: shingle_hashes(h[begin[d]:end[d]]).tolist()}
                found = self.best_at(runs[d], start, item, least)
                if found[0] >= least:
                    best[lo + d][item] = max(best[lo + d].get(item, (0.0, 0)), found)
        return best


_INDEX: dict[tuple[int, float], Index] = {}


def _index(part: list[tuple[int, str]], least: float) -> Index:
    """The index of a part of the benchmark, built once per Python worker; a worker
    keeps that of one part."""
    key = (hash(tuple(part)), least)
    if key not in _INDEX:
        _INDEX.clear()
        _INDEX[key] = Index(part, least)
    return _INDEX[key]


def _aligned(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words with every text moved to a multiple of ``STRIDE``, the text of every
    word (-1 in between), and where each text begins and ends."""
    n = np.diff(begin)
    first = np.concatenate(([0], np.cumsum(-(-n // STRIDE) * STRIDE)))
    out, doc = np.zeros(first[-1], dtype=h.dtype), np.full(first[-1], -1)
    at = np.arange(h.size) + np.repeat(first[:-1] - begin[:-1], n)
    out[at], doc[at] = h, np.repeat(np.arange(n.size), n)
    return out, doc, first[:-1], first[:-1] + n


def _runs(texts: list[str | None], most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about four million characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most or i == len(texts) - 1:
            yield lo, i + 1
            lo, size = i + 1, 0


def slices(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[bool, list[tuple[int, str]]]]:
    """The benchmark in parts of about ``SLICE_BYTES``, each with whether it is the
    last: the driver and a task hold one part at a time, whatever the benchmark's
    size; each part is one more pass."""
    b = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    size = b.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    n = max(1, math.ceil(size / SLICE_BYTES))
    for k in range(n):
        rows = b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()
        yield k == n - 1, [(r["i"], r["t"]) for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 least: float = SIMILARITY) -> DataFrame:
    """One row per document and benchmark item that it holds: ``doc_id, item_id,
    similarity, start_word`` (the best match, the first of equal ones).

    Null and empty texts and items, and items of under five words, match
    nothing; null and repeated ids are reported as they are, row by row; empty
    tables give no rows; other columns are ignored."""
    prepare(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for last, part in slices(benchmark):
        def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            index = _index(part, least)
            for b in batches:
                rows = [(i, index.items[k][0], s, -start)
                        for i, m in zip(b.column("doc_id").to_pylist(), index.matches(b.column("text").to_pylist(), least))
                        for k, (s, start) in sorted(m.items())]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.float64(), pa.int64()))], names=["doc_id", "item_id", "similarity", "start_word"])
        found = d.mapInArrow(run, "doc_id long, item_id long, similarity double, start_word long")
        found = found if last else written(found, "leaks")      # done before the next part is fetched
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark item."""
    prepare(docs.sparkSession)
    names, out, at = docs.columns, docs, unused(docs, "leak_text")
    for last, part in slices(benchmark):
        def keep(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
            index = _index(part, least)
            for b in batches:
                ok = [not m for m in index.matches(b.column(at).to_pylist(), least)]
                yield b.select(names).filter(pa.array(ok, pa.bool_()))
        out = out.withColumn(at, F.col("text").cast("string")).mapInArrow(keep, docs.schema)
        out = out if last else written(out, "clean")
    return out
