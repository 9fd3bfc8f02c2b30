"""Operators against a second, plain computation, and stages on clashing columns."""

import random
from collections import Counter

import numpy as np
import pytest
import zstandard

from hivewire.llm import bpe, common, decontaminate, langid, minhash, packing, quality, sharding
from tests.llm.test_operators import docs_df, prose


# --- 6: near copies at similarity just above 0.8 -------------------------------------

def similarity(a, b):
    a, b = (Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) for w in (a, b))
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def edited(r, item, word, edits):
    """The copy nearest to 0.8 from above of many with ``edits`` contiguous edits (0: single words)."""
    if not edits:
        c = list(item)
        while similarity(item, d := [word() if i == k else w for k in [r.randrange(len(c))] for i, w in enumerate(c)]) >= 0.8:
            c = d
        return c
    best = None
    for _ in range(150):
        c = list(item)
        n = max(1, r.randint(1, max(1, len(item) // 5)) // edits)
        for _ in range(edits):
            i, how = r.randrange(1, len(c) - 1), r.randrange(3)
            c[i:i + (n if how < 2 else 0)] = [word() for _ in range(n if how else 0)]
        s = similarity(item, c)
        if s >= 0.8 and (best is None or s < best[0]):
            best = (s, c)
    return best and best[1]


@pytest.mark.parametrize("vocabulary", [400, 5000])
def test_recall_of_near_copies(vocabulary):
    r = random.Random(vocabulary)
    word = lambda: f"w{r.randrange(vocabulary)}"        # noqa: E731
    words = lambda n: [word() for _ in range(n)]         # noqa: E731
    for n in (60, 120, 300, 600):
        for edits in (1, 2, 0):
            found = tried = 0
            for _ in range(15):
                item = words(n)
                copy = edited(r, item, word, edits)
                if copy is None:
                    continue
                text = words(r.randint(0, 300)) + copy + words(r.randint(0, 300))
                got = decontaminate.Index([(1, " ".join(item))]).matches([" ".join(text)])[0]
                tried, found = tried + 1, found + bool(got)
            assert found == tried if edits else found >= 0.9 * tried, (n, edits, found, tried)


# --- 7, 9: choice and density ------------------------------------------------------------

def test_language_is_the_smallest_compression():
    content = {k: prose(i, 400).encode() for i, k in enumerate(("xa", "xb", "xc"))}
    classify = langid.Classifier(content)
    r = random.Random(2)
    for i in range(30):
        words = content[r.choice(list(content))].decode().split()
        text = " ".join(r.choice(words) for _ in range(r.randint(1, 200)))
        raw, sizes = text.lower().encode(), {}
        for lang, c in content.items():
            z = zstandard.ZstdCompressor(level=langid.LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False,
                                         dict_data=zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            sizes[lang] = sum(len(z.compress(raw[a:a + langid.BLOCK])) for a in range(0, len(raw), langid.BLOCK))
        first, second = sorted(sizes.values())[:2]
        lang, score = classify(text)
        assert sizes[lang] == first and score == pytest.approx((second - first) / second)


def test_quality_is_the_difference_of_log_densities():
    r = np.random.default_rng(9)
    d = len(quality.FEATURES)
    x = {k: r.standard_normal((80 + 40 * k, d)) @ r.standard_normal((d, d)) + k for k in (0, 1)}
    model = quality.solve({k: (len(v), v.sum(axis=0), v.T @ v) for k, v in x.items()})
    cov = {k: np.cov(v.T, bias=True) for k, v in x.items()}
    pooled = sum(len(x[k]) * cov[k] for k in x) / sum(map(len, x.values()))
    log, at = {}, r.standard_normal((50, d))
    for k, v in x.items():
        c = (1 - quality.SHRINK) * cov[k] + quality.SHRINK * np.diag(np.diag(cov[k])) + quality.RIDGE * np.diag(np.diag(pooled)) + 1e-9 * np.eye(d)
        z = at - v.mean(axis=0)
        log[k] = -0.5 * (np.einsum("ij,jk,ik->i", z, np.linalg.inv(c), z) + np.linalg.slogdet(c)[1])
    prior = (len(x[1]) + 1) / (len(x[0]) + len(x[1]) + 2)
    want = 1 / (1 + np.exp(-np.clip(log[1] - log[0] + np.log(prior / (1 - prior)), -500, 500)))
    assert np.abs(model.score(at) - want).max() < 1e-8


# --- written outputs -----------------------------------------------------------------------

def test_written_packs_read_back(spark, tmp_path):
    texts = [prose(i, 3 * i) for i in range(20)] + [None, ""]
    got = packing.write_packed(docs_df(spark, texts), str(tmp_path / "packs"), length=64).collect()
    codec, ids = bpe.Codec(), {}
    for r in got:
        for a, b, doc, piece in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.pieces):
            ids[doc, piece] = list(r.ids[a:b])
    for i, t in enumerate(texts):
        want = codec.encode(t).tolist() if t else []
        assert [x for k in range(-(-len(want) // 64)) for x in ids[i, k]] == want
    assert packing.write_packed(docs_df(spark, []), str(tmp_path / "none"), length=64).count() == 0


def test_empty_shards(spark, tmp_path):
    # a partitioned table without a row has no schema of its own, so columns come from the documents
    assert sharding.assigned(docs_df(spark, [])).count() == 0


# --- stages keep every column, whatever its name ----------------------------------------------

def test_stages_keep_clashing_columns(spark):
    names = ["quality_text", "Lang_Text", "leak_text", "key_id", "KEY_TH", "_quality_text", "_lang_text", "_leak_text", "_k_id"]
    base = docs_df(spark, [prose(i, 60) for i in range(30)] + [prose(0, 60)])
    docs = base.select("*", *[base["doc_id"].cast("string").alias(n) for n in names])
    common.prepare(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id LONG, quality INT")
    item = spark.createDataFrame([(1, prose(3, 60))], "item_id LONG, text STRING")
    for out in (quality.accepted(docs, labels, 0.0), langid.accepted(docs), decontaminate.clean(docs, item), minhash.deduplicated(docs)):
        rows = out.collect()
        assert out.columns == docs.columns and all(r[n] == str(r.doc_id) for r in rows for n in names)
    assert {r.doc_id for r in decontaminate.clean(docs, item).collect()} == set(range(31)) - {3}
