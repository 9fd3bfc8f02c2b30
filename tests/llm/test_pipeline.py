"""The pipeline equals its stages' operators applied one after the other to
plain lists (brute force where there is any)."""

import hashlib

import corpus_pipeline as P
from hivewire.llm import bpe
from hivewire.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.llm.test_operators import near_brute


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = out.collect()
        seen[name] = (docs.collect(), rows)
        if name != P.STAGES[-1][0]:
            assert out.columns == columns and {r.doc_id for r in rows} <= {r.doc_id for r in seen[name][0]}
            docs = spark.createDataFrame(rows, docs.schema)
    before, after = seen["near_dedup"]
    before = sorted(before, key=lambda r: r.doc_id)
    comp = near_brute([r.text for r in before], P.NEAR_PERCENT)[1]
    assert sorted(r.doc_id for r in after) == [before[i].doc_id for i in sorted(set(comp))]
    before, after = seen["decontamination"]
    items = [" ".join(r.text.lower().split()) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    leaks = {r.doc_id for r in before if any(i in " ".join(r.text.lower().split()) for i in items)}
    assert leaks and {r.doc_id for r in before} - {r.doc_id for r in after} >= leaks
    before, after = seen["encoding"]
    text, codec = {r.doc_id: r.text for r in before}, bpe.Codec()
    assert len(after) == len(before)
    for r in after:
        assert r.ids == codec.encode(text[r.doc_id]).tolist()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_equals_the_stages(spark):
    got = P.run(spark, SF_SMALL)
    assert got.count() > 0 and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(got.columns)
