"""Registered queries of the training-data operators: each applies its
operator, with the parameters it is meant for, to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from . import (bpe, decontaminate, embed_dedup, langid, licenses, line_dedup, minhash, packing, quality, sharding, spelling,
               url_graph, whitening)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of ids, segment lengths and positions."""
    return packing.packed(read_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; digests of ids and bytes."""
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.assigned(read_table(spark, sf_dir, "documents")).drop("rid")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices and texts in the documents."""
    return licenses.scanned(read_table(spark, sf_dir, "documents"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every vector."""
    return embed_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the training folds."""
    return langid.predicted(read_table(spark, sf_dir, "documents"))


def op8_url_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page."""
    return url_graph.judged(read_table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from the training folds."""
    return quality.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the leading whitened components."""
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped from every document, and a digest of what stays."""
    return line_dedup.deduplicated(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of every frequent word."""
    return spelling.grouped(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_sharding": op3_sharding,
    "op4_licenses": op4_licenses,
    "op5_embeddings": op5_embeddings,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_url_graph": op8_url_graph,
    "op9_quality": op9_quality,
    "op10_minhash": op10_minhash,
    "op11_whitening": op11_whitening,
    "op12_line_dedup": op12_line_dedup,
    "op13_spelling": op13_spelling,
}

# Brute force over all pairs; components by the closure of the links.
_OP5_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= {embed_dedup.COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS vec_id, MIN(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, COUNT(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, COALESCE(n.n, 0) AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
FROM embeddings e JOIN comp ON comp.vec_id = e.vec_id LEFT JOIN n ON n.vec_id = e.vec_id
"""

_OP10_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, UNNEST(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM w),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {minhash.PERCENT} * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM documents d JOIN comp ON comp.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""

# The other operators are no SQL (learnt models, BPE, packing, greedy placement,
# ranks): tests/llm compares them with brute force and round trips.
SQL: dict[str, str] = {"op4_licenses": licenses.sql(), "op5_embeddings": _OP5_SQL, "op10_minhash": _OP10_SQL,
                       "op12_line_dedup": line_dedup.sql(), "op13_spelling": spelling.sql()}
