"""Language identification by compression (operator 7).

Per language a zstandard raw-content dictionary is made of a bounded, hashed
sample of labelled texts, lower-cased like every text.  A text is cut into blocks; every block is
compressed with each dictionary, and the language with the smallest total
wins.  The margin to the second best, relative to it, is the confidence;
narrow margins are rejected (the prediction is still reported).
"""

from __future__ import annotations

import re
from typing import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, unused

SAMPLE_SLOTS = 96           # at most so many sampled texts a language
SAMPLE_BYTES = 6_000        # texts up to this size are sampled whole, longer ones by passages
PASSAGES, PASSAGE = 16, SAMPLE_BYTES // 4       # at most so many passages a text; characters of each
DICT_BYTES = 96_000         # dictionary size a language
FULL_LANGUAGES = 64         # all are learnt; beyond so many, slots and dictionaries shrink
LEAST_BYTES = 8             # zstandard takes no smaller dictionary
BLOCK = 4_096               # bytes compressed at a time
LEVEL = 6
MARGIN = 0.002              # narrower relative margins are rejected
HELD_OUT_FOLD, FOLDS = 1, 3

_LETTER = re.compile(r"[^\W\d_]")


def fold(id_col="doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionary content per language, from the training folds' labelled texts.

    Rows are dealt to ``SAMPLE_SLOTS`` hash slots per language and each slot
    keeps the row with the smallest hash (a grouped minimum, combined before
    the shuffle), so the sample is bounded whatever the table's size.  A longer
    text gives hashed passages, which stay in slots without a short text.  Every
    language with a text is learnt; beyond ``FULL_LANGUAGES`` each has fewer
    slots and a smaller dictionary, so that their total stays about the same."""
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.crc32("id") % FOLDS != HELD_OUT_FOLD) & (F.octet_length("text") > 0))
    languages = max(FULL_LANGUAGES, rows.select("lang").distinct().count())
    slots = max(1, SAMPLE_SLOTS * FULL_LANGUAGES // languages)
    size = max(LEAST_BYTES, DICT_BYTES * FULL_LANGUAGES // languages)
    long = F.octet_length("text") > SAMPLE_BYTES
    ok = rows.where(~long).select("lang", F.lit(False).alias("long"), "text").unionByName(
        rows.where(long).select("lang", F.lit(True).alias("long"), F.explode(_passages(F.col("text"))).alias("text"))
        .where(F.replace("text", F.left("text", F.lit(1)), F.lit("")) != ""))      # one letter repeated says nothing
    picked = (ok.groupBy("lang", F.pmod(F.xxhash64("text"), F.lit(slots)).alias("slot"))
              .agg(F.min(F.struct("long", F.xxhash64("text", F.lit(1)).alias("h"), "text")).alias("m")).collect())
    sample: dict[str, list] = {}
    for r in picked:
        sample.setdefault(r["lang"], []).append(r["m"])
    out = {}
    for lang in sorted(sample):
        raw = b"\n".join(m["text"].lower().encode() for m in sorted(sample[lang], key=lambda m: (m["h"], m["text"])))
        # zstandard prefers recent content: what is cut off is the oldest
        out[lang] = (raw if len(raw) >= LEAST_BYTES else (raw + b"\n") * LEAST_BYTES)[-size:]
    return out


def _passages(text: Column) -> Column:
    """Up to ``PASSAGES`` passages of a long text: one at a hashed place of each of as many equal parts."""
    n = F.char_length(text)
    parts = F.least(F.lit(PASSAGES), F.greatest(F.lit(1), F.floor(n / PASSAGE))).cast("int")
    width = F.floor(n / parts).cast("int")
    free = F.greatest(F.lit(0), width - PASSAGE) + 1
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.substring(
        text, (i * width + F.pmod(F.xxhash64(text, i), free) + 1).cast("int"), F.lit(PASSAGE)))


class Classifier:
    """Compressors of all languages; made once per task."""

    def __init__(self, content: dict[str, bytes]):
        self.langs = sorted(content)
        self.compressors = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                                             write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """Language and confidence (0 to 1); ``und`` without text, letters or languages."""
        if not text or not self.langs or not _LETTER.search(text):
            return "und", 0.0
        raw = text.lower().encode()
        blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for c, lang in zip(self.compressors, self.langs))
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def predicted(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every document.

    ``score`` is the relative margin; ties go to the first language in
    alphabetical order with score 0.  Null texts, texts without a letter, and
    all texts when nothing could be learnt are ``und`` with score 0.  A null
    id is predicted, never held out and never learnt from.  An empty table
    gives no rows; other columns are ignored."""
    prepare(docs.sparkSession)
    content = learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(content)
        for b in batches:
            got = [classify(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in got], pa.string()),
                                              pa.array([x for _, x in got], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, lang_pred string, score double")
            .select("doc_id", F.coalesce(fold() == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score",
                    ((F.col("lang_pred") != "und") & (F.col("score") >= MARGIN)).alias("accepted")))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) with a language by a sufficient margin."""
    prepare(docs.sparkSession)
    content, names, at = learn(docs), docs.columns, unused(docs, "lang_text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(content)
        for b in batches:
            got = [classify(t) for t in b.column(at).to_pylist()]
            yield b.select(names).filter(pa.array([x != "und" and s >= MARGIN for x, s in got], pa.bool_()))

    return docs.withColumn(at, F.col("text").cast("string")).mapInArrow(keep, docs.schema)
