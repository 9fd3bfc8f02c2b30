"""Spelling variant grouping by reduced-alphabet generation (operator 13).

Words are counted natively (partial counts before the shuffle).  Letters hash
to ``SYMBOLS`` symbols (their code point modulo 8), so words one edit apart have
reduced words at most one edit apart.  The one-edit neighbourhood of every
reduced word is generated as 64-bit fingerprints: an edited word's polynomial
fingerprint follows from prefix sums, so a word of length L costs O(L) and not
O(L**2), also at L = 40,000.  Of the two ends of an edit one suffices: a reduced
word gives itself, its deletions (an insertion is a deletion of the other end)
and its replacements by a larger symbol.  The neighbourhoods join the reduced
vocabulary by fingerprint; candidates are verified on the original strings with
the edit distance, so colliding fingerprints only cost time.  Reduced words of
more than ``DENSE`` words are dealt to salted parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_unique, mix64, prepare, small, written

SYMBOLS = 8
LEAST_LENGTH, LEAST_COUNT = 6, 5    # code points and occurrences of a word
DROP_EVERY = 199                    # a run of a document loses a code point if this divides its checksum
FACTOR = 5                          # a form is this many times as frequent
DENSE = 1_000                       # words of one reduced word per part
CARRIED = 32                        # code points up to which a word travels with its fingerprints
SLICE = 100_000                     # fingerprints of one output batch

_A = np.uint64(0x9E3779B97F4A7C15 | 1)
_A_INV = np.uint64(pow(int(_A), -1, 1 << 64))
_SYMBOL = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64))   # one random number per symbol

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(x: Column) -> Column:
    """``x`` with A-Z lower-cased and nothing else."""
    return F.when(F.octet_length(x) == F.char_length(x), F.lower(x)).otherwise(F.translate(x, _UPPER, _LOWER))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least ``LEAST_LENGTH`` code points with at least
    ``LEAST_COUNT`` occurrences."""
    d = docs.select(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t"))
    runs = d.select("i", F.explode(F.regexp_extract_all("t", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("w"))
    runs = runs.where(F.char_length("w") >= LEAST_LENGTH).select("i", lower_ascii(F.col("w")).alias("w"))
    h = runs.select("w", F.crc32(F.concat("i", F.lit(":"), "w").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.char_length("w").cast("long")).cast("int")
    cut = F.concat(F.col("w").substr(F.lit(1), at), F.col("w").substr(at + 2, F.char_length("w")))
    words = h.select(F.when(F.col("h") % DROP_EVERY == 0, cut).otherwise(F.col("w")).alias("word"))
    return (words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT)))


def _power(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def fingerprints(reduced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of reduced words of one length (rows of symbols), and of
    each one's neighbours: itself, deletions, replacements by larger symbols.
    Equal neighbours of a word are given once (repeats as 0, which is no key)."""
    m, n = reduced.shape
    pw, inv = _power(_A, n + 1), _power(_A_INV, n + 1)
    term = _SYMBOL[reduced] * pw[:n]
    total = term.sum(axis=1, dtype=np.uint64)
    prefix = np.cumsum(term, axis=1, dtype=np.uint64)
    key = mix64(total ^ np.uint64(n)) | np.uint64(1)
    # without symbol i: what stands before it, and what stands after it one place down
    less = (prefix - term) + (total[:, None] - prefix) * inv[1]
    less = mix64(less ^ np.uint64(n - 1)) | np.uint64(1)
    less[:, 1:][reduced[:, 1:] == reduced[:, :-1]] = 0        # in a run of equal symbols all deletions are one
    out = [key[:, None], less]
    for s in range(1, SYMBOLS):
        other = total[:, None] - term + _SYMBOL[s] * pw[:n]
        out.append(np.where(reduced < s, mix64(other ^ np.uint64(n)) | np.uint64(1), np.uint64(0)))
    return key, np.concatenate(out, axis=1)


def _by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions and reduced words of equally long words, some at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for n, rows in groups.items():
        step = max(1, SLICE // (n * SYMBOLS))
        for a in range(0, len(rows), step):
            part = rows[a:a + step]
            code = np.frombuffer("".join(words[i] for i in part).encode("utf-32-le"), np.uint32).reshape(len(part), n)
            yield part, (code % SYMBOLS).astype(np.int64)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = b.column("word").to_pylist()
        key = np.zeros(len(words), np.uint64)
        for part, code in _by_length(words):
            key[part] = fingerprints(code)[0]
        yield pa.RecordBatch.from_arrays([b.column("wid"), b.column("word"), b.column("n"), pa.array(key.view(np.int64))],
                                         names=["wid", "word", "n", "key"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words, ids = b.column("word").to_pylist(), b.column("wid").to_numpy()
        carried = pa.array([w if len(w) <= CARRIED else None for w in words], pa.string())
        for part, code in _by_length(words):
            keys = fingerprints(code)[1]
            row, col = np.nonzero(keys)
            of = np.array(part)[row]
            keys = keys[row, col].view(np.int64)
            for a in range(0, keys.size, SLICE):
                yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + SLICE]), pa.array(ids[of[a:a + SLICE]]),
                                                  carried.take(pa.array(of[a:a + SLICE]))], names=["key", "a", "word_a"])


def _candidates(v: DataFrame) -> DataFrame:
    """``a, word_a, b, word_b``: pairs of words whose reduced words are at most
    one edit apart, each from one end or (equal reduced words) from both;
    ``word_a`` is null for long words."""
    near = v.select("wid", "word").mapInArrow(_neighbours, "key long, a long, word_a string")
    vocab = v.select("key", F.col("wid").alias("b"), F.col("word").alias("word_b"))
    dense = written(v.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > DENSE)
                    .select("key", F.ceil(F.col("m") / DENSE).alias("parts")), "dense")
    on = ["key"]
    if not dense.isEmpty():     # at most one key for every DENSE words; counted before any broadcast
        dense = small(dense)
        near = near.join(dense, "key", "left").select("key", "a", "word_a", F.explode(
            F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        vocab = vocab.join(dense, "key", "left").select("key", "b", "word_b", F.pmod(
            F.xxhash64("b"), F.coalesce("parts", F.lit(1))).alias("part"))
        on = ["key", "part"]
    return near.join(vocab, on).where("a <> b").select("a", "word_a", "b", "word_b")


def links(v: DataFrame) -> DataFrame:
    """``a, b`` (ids of the vocabulary ``v(wid, word, n, key)``), both ways, for
    words exactly one inserted, deleted or replaced code point apart."""
    c = _candidates(v)
    at_one = F.levenshtein("word_a", "word_b", 1) == 1
    short = c.where(F.col("word_a").isNotNull()).where(at_one).select("a", "b")
    names = v.where(F.char_length("word") > CARRIED).select(F.col("wid").alias("a"), F.col("word").alias("word_a"))
    long = c.where(F.col("word_a").isNull()).drop("word_a").join(names, "a").where(at_one).select("a", "b")
    one = written(short.unionByName(long), "near")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``wid, root`` for words with a form ``(wid, form)``: paths are halved until
    nothing moves.  A form is at least ``FACTOR`` times as frequent, so a path has
    at most the logarithm of the largest count steps."""
    p = forms.select("wid", F.col("form").alias("root"))
    while True:
        up = p.select(F.col("wid").alias("root"), F.col("root").alias("up"))
        q = written(join_unique(p, up, "root").select("wid", F.coalesce("up", "root").alias("root"),
                                                      F.col("up").isNotNull().alias("moved")), "roots")
        if q.where("moved").isEmpty():
            return q.select("wid", "root")
        p = written(q.select("wid", "root"), "paths")


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the documents.

    A word's form is its near word of largest count (ties: the smallest in
    code-point order) if that count is at least ``FACTOR`` times its own, else
    null; its root is where its forms lead.  Null and empty texts have no words;
    a null id counts as an empty one in the checksum; repeated rows count as
    often as they stand; words of any length are compared.  An empty table, or
    one without frequent words, gives no rows; other columns are ignored."""
    prepare(docs.sparkSession)
    counted = written(vocabulary(docs, id_col, text_col), "words")
    v = written(counted.select(F.monotonically_increasing_id().alias("wid"), "word", "n")
                .mapInArrow(_reduced, "wid long, word string, n long, key long"), "vocabulary")
    names = v.select(F.col("wid").alias("b"), F.col("n").alias("n_b"), F.col("word").alias("word_b"))
    near = links(v).join(names, "b").groupBy(F.col("a").alias("wid")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("m"), "word_b", "b")).alias("top"))
    best = written(v.join(near, "wid", "left").select("wid", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                   F.when(-F.col("top.m") >= FACTOR * F.col("n"), F.struct(
                       F.col("top.b").alias("b"), F.col("top.word_b").alias("word"), (-F.col("top.m")).alias("n"))).alias("form")), "best")
    roots = _roots(best.where("form IS NOT NULL").select("wid", F.col("form.b").alias("form")))
    named = best.join(roots, "wid", "left")
    of_root = join_unique(written(named, "rooted"), v.select(F.col("wid").alias("root"), F.col("word").alias("root_word")), "root", fixed=False)
    return of_root.select("word", F.col("form.word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near",
                          F.col("form.n").alias("form_n"))


def sql() -> str:
    """The same rows as DuckDB SQL: checksums bit by bit, and near words by equal
    deletions (a replacement leaves equal words without the same position)."""
    return f"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
runs AS (SELECT doc_id, UNNEST(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, translate(w, '{_UPPER}', '{_LOWER}') AS w, COUNT(*) AS n FROM runs GROUP BY 1, 2),
b AS (SELECT w, n, flatten(list_transform(string_split(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda c:
  CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END)) AS bytes FROM r WHERE length(w) >= {LEAST_LENGTH}),
h AS (SELECT w, n, xor(4294967295, list_reduce(bytes, lambda c, x: xor(t.t[1 + (xor(c, x) & 255)], c >> 8), 4294967295)) AS h FROM b, t),
k AS (SELECT CASE WHEN h % {DROP_EVERY} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS (SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM k WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING SUM(n) >= {LEAST_COUNT}),
d AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, UNNEST(range(length(word))) AS i FROM v)),
near AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.less = v.word UNION SELECT v.word, d.word FROM d JOIN v ON d.less = v.word),
best AS (SELECT a AS word, COUNT(*) AS n_near, arg_min(struct_pack(b := b, n := v.n), struct_pack(m := -v.n, b := b)) AS top
  FROM near JOIN v ON v.word = near.b GROUP BY a),
f AS (SELECT v.word, v.n, COALESCE(n_near, 0) AS n_near, CASE WHEN top.n >= {FACTOR} * v.n THEN top.b END AS form,
  CASE WHEN top.n >= {FACTOR} * v.n THEN top.n END AS form_n FROM v LEFT JOIN best ON best.word = v.word),
path AS (SELECT word, word AS at FROM f UNION ALL SELECT path.word, f.form FROM path JOIN f ON f.word = path.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, path.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN path ON path.word = f.word JOIN f AS g ON g.word = path.at AND g.form IS NULL
"""
