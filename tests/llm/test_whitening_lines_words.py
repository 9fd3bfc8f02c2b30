"""Operators 11 to 13 against direct computations, and on odd tables."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from hivewire.llm import line_dedup, spelling, whitening
from hivewire.sources.tables import read_table
from scripts.check_oracle import canon, duck
from tests.conftest import SF_SMALL

# extra columns have names that the operators use inside
DOC = "doc_id LONG, text STRING, th LONG, key STRING, line STRING, gone INT, w STRING, n LONG"


def docs_df(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "l", 2, "w", 3) for i, t in rows], DOC)


@pytest.mark.parametrize("name", ["op12_line_dedup", "op13_spelling"])
def test_query_matches_sql(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck(SF_SMALL).execute(entry.oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, rel.fetchall())


# --- 11 whitening ------------------------------------------------------------------------

def vectors_df(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id LONG, embedding ARRAY<FLOAT>, label INT, x STRING, c0 DOUBLE")


def directly(ids, vectors, k=8):
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    xc = x - s / n
    v = xc.T @ xc / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return e / np.trace(v), xc @ q / np.sqrt(e), ((n * x - s) ** 2).sum(axis=1)


def compare(rows, ids, vectors, k=8):
    share, white, dev = directly(ids, vectors, k)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == len(ids) and r.identity_error < 1e-9 and abs(r.explained - share[r.component - 1]) < 1e-12
    assert len(rows) == len(ids) * white.shape[1]
    for c in range(1, white.shape[1] + 1):
        mine = np.array([got[i][c].whitened for i in ids])
        assert min(np.abs(mine - white[:, c - 1]).max(), np.abs(mine + white[:, c - 1]).max()) < 1e-8
    assert [got[i][1].deviation for i in ids] == dev.tolist()


def test_whitening_equals_eigenvectors(spark):
    t = read_table(spark, SF_SMALL, "embeddings").orderBy("vec_id").collect()
    compare(entry.queries()["op11_whitening"](spark, SF_SMALL).collect(), [r.vec_id for r in t], [r.embedding for r in t])


def test_whitening_certifies_close_eigenvalues():
    r = np.random.default_rng(3)
    for spread in (1e-3, 1e-6):
        q = np.linalg.qr(r.standard_normal((96, 96)))[0]
        e = np.concatenate((1 + spread * np.arange(20)[::-1], np.linspace(0, 1 - spread, 76)[::-1]))
        v = (q * e) @ q.T
        got, u = whitening.leading(lambda b: v @ b, 96, 8)
        assert np.abs(got - np.sort(e)[::-1][:8]).max() < 1e-12
        assert np.abs(v @ u - u * got).max() < 1e-11 and np.abs(u.T @ u - np.eye(8)).max() < 1e-12


def test_whitening_odd_vectors(spark):
    r = np.random.default_rng(4)
    good = [(i, [float(x) for x in r.standard_normal(5)]) for i in range(40)]
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [float("nan")] * 5), (94, [float("inf")] * 5),
           (95, [1.0, 2.0]), (96, [3e38] * 5)]
    compare(whitening.whitened(vectors_df(spark, good + bad)).collect(), [i for i, _ in good], [v for _, v in good], 5)
    for rows in ([], bad[:2], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]):
        assert whitening.whitened(vectors_df(spark, rows)).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)] + [(None, [4.0, 8.0, 0.0])]
    got = whitening.whitened(vectors_df(spark, line)).collect()
    assert len(got) == 10 and {g.component for g in got} == {1} and all(abs(g.explained - 1) < 1e-12 for g in got)


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float((-1) ** i * 2.0 ** 39), 0.0]) for i in range(4)]
    assert {g.deviation for g in whitening.whitened(vectors_df(spark, rows)).collect()} == {None}


# --- 12 lines ------------------------------------------------------------------------------

def lines_directly(rows):
    order = lambda i: (i is None, i or 0)       # noqa: E731
    strip = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for i, t in rows:
        for k in map(strip, (t or "").split("\n")):
            if len(k) >= 10:
                first[k] = min(first.get(k, i), i, key=order)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if first.get(strip(x), i) == i]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


def random_docs(seed, n, ids):
    r = random.Random(seed)
    pool = ["short", "", "  ", "a common line of text", "A Common LINE of text \t", "\x0bÄ line with capitals É", "ä line with capitals é",
            "ten chars!", "nine char", " not stripped ", "line\x1cof text", "x" * 3000] + [f"line number {i}" for i in range(60)]
    return [(ids(r, i), "\n".join(r.choice(pool) for _ in range(r.randint(1, 12)))) for i in range(n)]


@pytest.mark.parametrize("slices", [1, 7])
def test_line_dedup_equals_direct(spark, slices):
    rows = random_docs(slices, 300, lambda r, i: r.choice([None, *range(100)]) if i % 3 else i)
    rows += [(0, None), (1, ""), (2, "\n\n"), (None, "a common line of text"), (400, "\n".join(["the same line"] * 5000)), (401, "The same line ")]
    got = line_dedup.deduplicated(docs_df(spark, rows), slices=slices).collect()
    assert sorted(map(tuple, got), key=str) == lines_directly(rows)


def test_line_runs_continue_and_compact(spark):
    rows = random_docs(9, 240, lambda r, i: i)
    runs, got = line_dedup.LineRuns(spark, 4, fan=2), []
    for a in range(0, 240, 30):
        part = docs_df(spark, [x for x in rows if a <= x[0] < a + 30])
        got += line_dedup.deduplicated(part, slices=1, runs=runs).collect()
    assert sorted(map(tuple, got), key=str) == lines_directly(rows)
    assert sum(len(level) for level in runs.levels) < 8 and max(len(level) for level in runs.levels) <= 2
    hashes = [tuple(r) for t in runs.tables() for r in spark.table(t).select("h1", "h2").collect()]
    assert len(hashes) == len(set(hashes))


def test_line_runs_are_merged_without_a_shuffle_of_runs(spark):
    runs = line_dedup.LineRuns(spark, 4)
    for i in range(2):
        line_dedup.deduplicated(docs_df(spark, [(i, f"some line of text {i}")]), slices=1, runs=runs)
    a, b = map(spark.table, runs.tables())
    with runs._sorted_join():
        plan = a.join(b.hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan


def test_line_dedup_empty_table_and_plan(spark):
    assert line_dedup.deduplicated(docs_df(spark, [])).collect() == []
    assert line_dedup.deduplicated(docs_df(spark, [(None, None), (None, "")])).select("text", "n_lines", "n_dropped").collect() == [("", 1, 0)] * 2
    plan = entry.queries()["op12_line_dedup"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- 13 words --------------------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def words_directly(rows):
    lower = {i: i + 32 for i in range(65, 91)}
    count = collections.Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            count[w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    friends = {w: [u for u in n if near(w, u)] for w in n}
    form = {}
    for w in n:
        best = min(friends[w], key=lambda u: (-n[u], u), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(friends[w]), n.get(form.get(w))))
    return sorted(out, key=str)


def test_words_equal_direct(spark, monkeypatch):
    r = random.Random(13)
    base = ["aaaaaa", "aaaaaaa", "abcabc", "Straße", "garçonÿ", "multiplication×", "colour", "color" * 2]
    def edited(w):
        i, k, c = r.randrange(len(w)), r.randrange(3), r.choice("abixyÀÿ")
        return w[:i] + ("" if k == 0 else c) + w[i + (k != 1):]
    texts = []
    for i in range(400):
        words = []
        for _ in range(12):
            w = r.choice(base)
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                w = edited(w)
            words.append(w.upper() if r.random() < 0.1 else w)
        texts.append((r.choice([None, i]), " ".join(words) + r.choice([".", "123", "\n"])))
    long = "b" * 20_000
    texts += [(0, None), (1, ""), (2, " ".join([long] * 5)), (3, " ".join([long[1:] + "c"] * 6)), (4, " ".join([long + "b"] * 30)), (4, "colour " * 4),
              (5, "chainword " * 400 + "chainwordx " * 40 + "chainwordxy " * 5)]
    want = words_directly(texts)
    got = sorted(map(tuple, spelling.grouped(docs_df(spark, texts)).collect()), key=str)
    assert got == want and sum(x[1] is not None for x in want) > 20 and any(x[1] is not None and x[2] != x[1] for x in want)
    monkeypatch.setattr(spelling, "DENSE", 2)      # reduced words in salted parts
    monkeypatch.setattr(spelling, "CARRIED", 8)
    assert sorted(map(tuple, spelling.grouped(docs_df(spark, texts)).collect()), key=str) == want


def test_neighbourhoods_are_complete():
    r = random.Random(2)
    for _ in range(300):
        n = r.randint(1, 7)
        w = [r.randrange(spelling.SYMBOLS) for _ in range(n)]
        u, i, k = list(w), r.randrange(n), r.randrange(3)
        if k == 0:
            del u[i]
        elif k == 1:
            u.insert(i, r.randrange(spelling.SYMBOLS))
        else:
            u[i] = r.randrange(spelling.SYMBOLS)
        key = lambda x: spelling.fingerprints(np.array([x], dtype=np.int64).reshape(1, len(x)))
        if u:
            assert key(w)[0][0] in key(u)[1] or key(u)[0][0] in key(w)[1]
        given = [x for x in key(w)[1][0].tolist() if x]
        assert len(given) == len(set(given))


def test_no_words(spark):
    for rows in ([], [(1, None), (2, ""), (None, "1 2 3"), (3, "seldom")]):
        assert spelling.grouped(docs_df(spark, rows)).collect() == []


def test_kept_digest(spark):
    row = entry.queries()["op12_line_dedup"](spark, SF_SMALL).where("n_dropped = 0").first()
    text = read_table(spark, SF_SMALL, "documents").where(F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
