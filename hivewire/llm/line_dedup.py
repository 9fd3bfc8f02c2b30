"""Line dedup by levelled sorted runs of line hashes (operator 12), DataFrame
functions only.

The lines of a batch of documents become 128-bit hashes.  A run is a table of
the hashes that one batch saw first, bucketed and sorted by hash, with the
document that holds each first.  A new batch

1. reduces its hashes to one row each (smallest document, partial minimum),
2. merge-anti-joins them with every run (equal bucketing: the runs are not
   shuffled), which leaves the hashes never seen before,
3. adds these as its own run, and
4. anti-joins its lines with that run by hash *and* document: a line that is not
   at its hash's first document is dropped.  The document in the key keeps a
   line that every document has from meeting in one task.

``FAN`` runs of a level are merged into one of the next before another run
joins them, so a batch meets at most ``FAN`` runs per level, logarithmically many.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import prepare, written

LEAST_LENGTH = 10       # code points of a key
SLICES = 6              # batches that a whole table is taken in, by id
FAN = 3                 # runs of a level before they are merged
BUCKET_ROWS = 4_000_000     # hashes of a run per bucket, on whose number the first batch decides

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = " \t\n\x0b\x0c\r"


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs inside, put back afterwards."""
    names = {k: k.replace("__", ".") for k in values}
    before = {n: spark.conf.get(n, None) for n in names.values()}
    for k, n in names.items():
        spark.conf.set(n, values[k])
    try:
        yield
    finally:
        for n, x in before.items():
            spark.conf.unset(n) if x is None else spark.conf.set(n, x)


class LineRuns:
    """The lines seen so far, as levels of sorted runs under ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, buckets: int, fan: int = FAN) -> None:
        self.spark, self.buckets, self.fan = spark, buckets, fan
        self.levels: list[list[str]] = []       # table names, oldest first

    def _sorted_join(self):
        # one file per bucket, so a scan is already in the order that a merge join needs
        return _settings(self.spark, spark__sql__shuffle__partitions=str(self.buckets),
                         spark__sql__legacy__bucketedTableScan__outputOrdering="true")

    def _store(self, rows: DataFrame) -> str:
        """Write ``rows``, partitioned by hash as the buckets are, as a run."""
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", scratch_path(self.spark, "llm-line-run")).saveAsTable(name))
        return name

    def tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def _compact(self, level: int = 0) -> None:
        """Merge a full level into one run of the next (its hashes are distinct:
        every run lacked those of the runs before it)."""
        while len(self.levels) <= level + 1:
            self.levels.append([])
        if len(self.levels[level]) < self.fan:
            return
        self._compact(level + 1)
        old = self.levels[level]
        rows = self.spark.table(old[0])
        for t in old[1:]:
            rows = rows.unionByName(self.spark.table(t))
        with _settings(self.spark, spark__sql__unionOutputPartitioning="false"):    # one file per bucket: shuffled
            self.levels[level + 1].append(self._store(rows.repartition(self.buckets, "h1", "h2")))
        self.levels[level] = []
        for t in old:
            self.spark.sql(f"DROP TABLE {t}")

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch ``lines(h1, h2, doc_id, ...)`` (written) and give its rows
        whose hash an earlier batch or a smaller document holds."""
        self._compact()
        with self._sorted_join():
            run = self._store(lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id")))
            if self.tables():
                new = self.spark.table(run)
                for t in self.tables():
                    new = new.join(self.spark.table(t).hint("merge"), ["h1", "h2"], "left_anti")
                whole, run = run, self._store(new)
                self.spark.sql(f"DROP TABLE {whole}")
        self.levels[0].append(run)
        first = self.spark.table(run).select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first_id")
        return written(lines.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2"))
                                  & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_anti"), "dropped-lines")


def keys(line: Column) -> tuple[Column, Column]:
    """A line stripped at both ends, and that with A-Z lower-cased."""
    bare = F.trim(line, F.lit(_BLANK))
    low = F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))
    return bare, low


def hashed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, th, line_no, h1, h2`` of every line of ``docs(doc_id, text)`` whose
    key is long enough; ``th`` tells texts of one id apart."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    bare, low = keys(F.col("line"))
    low = lines.where(F.char_length(bare) >= LEAST_LENGTH).select("doc_id", "th", "line_no", low.alias("key"))
    return low.select("doc_id", "th", "line_no", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(12), "key").alias("h2"))


def deduplicated(docs: DataFrame, slices: int = SLICES, runs: LineRuns | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``: every document's text without the
    lines that a document of smaller id (or, given ``runs`` that earlier calls
    filled, of an earlier call) holds too.

    The table is taken in ``slices`` batches of ascending ids.  A null text is an
    empty one; an empty text is one empty line.  Rows of one id count as one
    document (and all keep a line that it holds first); null ids are one
    document, after all others.  Lines with keys of fewer than ``LEAST_LENGTH``
    code points stay.  An empty table gives no rows; other columns are ignored."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / slices for i in range(1, slices)], 10_000)).first()[0] if slices > 1 else None
    cuts = sorted(set(cuts or []))
    part = F.lit(0)
    for c in cuts:
        part = part + (F.col("doc_id") > c).cast("int")
    path = scratch_path(spark, "llm-lines")
    (hashed_lines(docs).withColumn("slice", F.coalesce(part, F.lit(len(cuts)))).write.partitionBy("slice").parquet(path))
    lines = spark.read.schema("doc_id long, th long, line_no int, h1 long, h2 long, slice int").parquet(path)
    if runs is None:
        runs = LineRuns(spark, max(8, -(-lines.count() // BUCKET_ROWS)))
    dropped = None
    for i in range(len(cuts) + 1):
        rows = runs.add(lines.where(F.col("slice") == i).drop("slice"))
        dropped = rows if dropped is None else dropped.unionByName(rows)
    gone = dropped.groupBy("doc_id", "th").agg(F.collect_set("line_no").alias("gone")).select(
        F.col("doc_id").alias("g_id"), F.col("th").alias("g_th"), "gone")
    d = docs.withColumn("th", F.xxhash64("text"))
    d = d.join(gone, d["doc_id"].eqNullSafe(gone["g_id"]) & (d["th"] == gone["g_th"]), "left")
    d = d.select("doc_id", F.split("text", "\n").alias("lines"), "text", "gone")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    d = d.select("doc_id", "lines", "text", "gone", F.when(F.col("gone").isNotNull(), stay).alias("stay"))
    return d.select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("lines") - F.size("stay")).cast("long").alias("n_dropped"))


def sql() -> str:
    """The same rows as DuckDB SQL, by keys instead of hashes and runs."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, UNNEST(range(len(l))) AS i, UNNEST(l) AS line FROM d),
k AS (SELECT doc_id, i, line, translate(trim(line, {blank}), '{_UPPER}', '{_LOWER}') AS key FROM lines),
f AS (SELECT key, MIN(doc_id) AS first_id FROM k WHERE length(key) >= {LEAST_LENGTH} GROUP BY key),
j AS (SELECT k.doc_id, i, line, COALESCE(f.first_id <> k.doc_id, FALSE) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (gone) AS n_dropped,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
