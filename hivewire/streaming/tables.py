"""Log-structured tables that a streaming job keeps next to its checkpoint.

A micro-batch writes only the rows that it adds or replaces, as a delta folder
hash-partitioned by key.  After ``every`` deltas the buckets that they touch are
merged with their base and rewritten; other buckets stay as they are.  What
belongs to the table after a batch is listed in that batch's manifest, a small
file put in place by a rename after all it names is written, so a reader sees
a whole version or none.

Exactly once: a batch reads the newest manifest of an *earlier* batch and
(over)writes folders of its own number, so a replayed batch starts from the
same version and leaves the same one.  Folders that neither the newest manifest
nor the one before (which a replay reads) names are removed after the commit:
a version has at most one base folder per bucket and ``every`` deltas, however
long the job runs.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, EVERY = 8, 8


class JobTable:
    """Rows of ``schema`` by ``key``.  ``order`` (columns, largest wins) tells which row
    of a key counts, after them the later batch; ``None``: a key is written once
    only (the caller adds new keys alone) and nothing is reduced."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], order: list[str] | None = None,
                 buckets: int = BUCKETS, every: int = EVERY):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order
        self.buckets, self.every = buckets, every
        self.schema = schema + ", batch LONG"
        self.columns = spark.createDataFrame([], schema).columns
        jvm = spark._jvm
        self._Path, self._io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self._fs = self._Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        if not self._ids():
            self._put(-1, {"base": {}, "deltas": []})

    # --- files ---------------------------------------------------------------

    def _file(self, *parts: str):
        return self._Path("/".join((self.path, *parts)))

    def _names(self, *parts: str) -> list[str]:
        where = self._file(*parts)
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def _ids(self) -> list[int]:
        """Batches with a manifest, oldest first."""
        return sorted(int(n[1:]) for n in self._names("manifests") if n.startswith("m"))

    def _get(self, batch_id: int) -> dict:
        stream = self._fs.open(self._file("manifests", f"m{batch_id}"))
        try:
            return json.loads(self._io.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _put(self, batch_id: int, manifest: dict) -> None:
        draft, final = self._file("manifests", f"_draft{batch_id}"), self._file("manifests", f"m{batch_id}")
        stream = self._fs.create(draft, True)
        try:
            self._io.write(json.dumps(manifest), stream, "UTF-8")
        finally:
            stream.close()
        self._fs.delete(final, False)       # only what an earlier try of this batch left
        if not self._fs.rename(draft, final):
            raise OSError(f"cannot put the manifest of batch {batch_id} in place under {self.path}")

    # --- versions ---------------------------------------------------------------

    def _version(self, batch_id: int) -> dict:
        """What the batches before ``batch_id`` left."""
        return self._get(max(i for i in self._ids() if i < batch_id))

    def _rows(self, base: list[str], deltas: list[str]) -> DataFrame:
        """Rows of base folders and deltas, the counting one of every key."""
        out = self.spark.createDataFrame([], self.schema)
        if base:
            out = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in base])
        for d in deltas:
            out = out.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.path}/{d}").select(*out.columns))
        if self.order is None:
            return out
        rest = [c for c in out.columns if c not in self.key]
        return (out.groupBy(*self.key).agg(F.max_by(F.struct(*rest), F.struct(*self.order, "batch")).alias("r"))
                .select(*self.key, "r.*").select(*out.columns))

    def before(self, batch_id: int) -> DataFrame:
        """The table as the batches before ``batch_id`` left it, one row per key."""
        v = self._version(batch_id)
        return self._rows(sorted(f"{f}/bucket={b}" for b, f in v["base"].items()), [d for d, _ in v["deltas"]]).drop("batch")

    def current(self) -> DataFrame:
        return self.before(max(self._ids()) + 1)

    def write(self, rows: DataFrame, batch_id: int, keep: Column | None = None) -> None:
        """Commit the rows that batch ``batch_id`` adds or replaces.  Where buckets are
        rewritten, rows that ``keep`` is not true for have had their time and go; with
        ``keep``, every ``every ** 2`` batches all buckets are."""
        v = self._version(batch_id)
        delta = f"delta-{batch_id}"
        self._save(rows.select(*self.columns).withColumn("batch", F.lit(batch_id).cast("long")), delta)
        touched = [n[7:] for n in self._names(delta) if n.startswith("bucket=")]
        if touched:
            v["deltas"].append([delta, touched])
        sweep = keep is not None and (batch_id + 1) % self.every ** 2 == 0 and (v["base"] or v["deltas"])
        if sweep or len(v["deltas"]) >= self.every:
            hit = sorted({b for _, of in v["deltas"] for b in of} | (set(v["base"]) if sweep else set()))
            base = f"base-{batch_id}"
            whole = self._rows([f"{v['base'][b]}/bucket={b}" for b in hit if b in v["base"]], [d for d, _ in v["deltas"]])
            self._save(whole if keep is None else whole.where(keep), base)
            left = {n[7:] for n in self._names(base) if n.startswith("bucket=")}     # a bucket may have no row left
            kept = {b: f for b, f in v["base"].items() if b not in hit}
            v = {"base": {**kept, **{b: base for b in hit if b in left}}, "deltas": []}
        self._put(batch_id, v)
        self._clean()

    def _save(self, rows: DataFrame, folder: str) -> None:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        rows.withColumn("bucket", bucket).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.path}/{folder}")

    def _clean(self) -> None:
        """Remove what the two newest versions do not name."""
        ids = self._ids()
        named = {"manifests"}
        for i in ids[-2:]:
            v = self._get(i)
            named |= {*v["base"].values(), *(d for d, _ in v["deltas"])}
        for i in ids[:-2]:
            self._fs.delete(self._file("manifests", f"m{i}"), False)
        for n in self._names():
            if n not in named:
                self._fs.delete(self._file(n), True)
