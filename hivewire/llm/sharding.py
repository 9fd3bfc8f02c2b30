"""Sharding by vector bin packing (operator 3).

Rows with equal texts form a group whose demand is a vector: bytes, tokens
(words) and rows, each as a share of the table's total.  Units are placed one
by one, largest first, into the shard whose residual capacity has the highest
dot product with the unit's demand; the shards' bytes come out near equal (law
``bytes``), and words and rows with them.

What reaches the driver is bounded by the number of shards, not by the data:
groups above a share of the total (their number is bounded by the inverse of
the share) are units of their own; all lighter groups fall by hash into a fixed
number of cells, which are units; a hot group above ``SPLIT`` of a shard is cut
into pieces by row hash.  Slots come from counts of row-hash buckets, so no
task numbers a whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, small, written

SHARDS = 24
SPLIT = 4          # a group above 1/4 of a shard is split ...
PIECE = 64         # ... into pieces of about 1/64 of a shard
HEAVY = 64         # a group above 1/64 of a shard is placed on its own
CELLS = 4_096      # hash cells of all other groups
SLOT_ROWS = 20_000  # rows that one task numbers, about


def place(demand: np.ndarray, shards: int) -> np.ndarray:
    """Shard per unit.  ``demand`` has a row per unit and a column per resource,
    as shares of the totals (columns without any total are zero).  Units go
    largest first (ties: in the order given); ties between shards go to the
    lowest number."""
    residual = np.full((shards, demand.shape[1]), 1.0 / shards)
    out = np.zeros(len(demand), dtype=np.int64)
    for i in np.argsort(-demand.max(axis=1), kind="stable"):
        s = int(np.argmax(residual @ demand[i]))
        out[i] = s
        residual[s] -= demand[i]
    return out


def assigned(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid, doc_id, size, text_crc32, law, shard, slot, grown_shard`` per row.

    ``size`` is the text's UTF-8 bytes (null: none) plus 8; the checksum of a
    null text is 0.  Null texts are one group, empty texts another.  Null and
    repeated ids are rows like any other, told apart by ``rid``.  An empty
    table gives no rows; other columns are ignored."""
    spark = prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    nbytes = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    items = written(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), (nbytes + 8).alias("size"),
        F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long").alias("words"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"), F.xxhash64(text).alias("g")), "items")
    sums = (F.sum("size").alias("b"), F.sum("words").alias("w"), F.count(F.lit(1)).alias("r"))
    total = items.agg(*sums).first()
    if not total["r"]:
        return items.select("rid", "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                            F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    totals = np.array([total["b"], max(1, total["w"]), total["r"]], dtype=float)
    share = F.greatest(F.col("b") / totals[0], F.col("w") / totals[1], F.col("r") / totals[2])
    # at most 3 * shards * HEAVY groups can have so large a share
    large = items.groupBy("g").agg(*sums).select("g", share.alias("share")).where(F.col("share") > 1 / (shards * HEAVY))
    large = written(large.select("g", F.when(F.col("share") > 1 / (shards * SPLIT), F.ceil(F.col("share") * shards * PIECE))
                                 .otherwise(1).cast("long").alias("pieces")), "large")
    units = items.join(F.broadcast(large), "g", "left").withColumn(
        "kind", F.when(F.col("pieces").isNull(), 1).otherwise(0)).withColumn(
        "a", F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("g"), F.lit(CELLS))).otherwise(F.col("g"))).withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("rid"), F.col("pieces")), F.lit(0)))
    key = ["kind", "a", "piece"]
    found = sorted((tuple(r) for r in units.groupBy(*key).agg(*sums).collect()))
    demand = np.array([x[3:] for x in found], dtype=float) / totals
    shard = place(demand, shards).tolist()
    where = spark.createDataFrame([(int(k), int(a), int(p), s) for (k, a, p, *_), s in zip(found, shard)],
                                  "kind int, a long, piece long, shard int")
    subs = max(16, -(-total["r"] // (shards * SLOT_ROWS)))
    dealt = written(units.join(F.broadcast(where), key).select(
        "rid", "doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("rid"), F.lit(subs)).alias("sub")), "dealt")
    counts = dealt.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "sub", (F.sum("n").over(Window.partitionBy("shard").orderBy("sub")) - F.col("n")).alias("before"))
    before = written(before, "slots")
    rank = F.row_number().over(Window.partitionBy("shard", "sub").orderBy("rid"))
    return (dealt.withColumn("rank", rank).join(small(before), ["shard", "sub"])
            .select("rid", "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write ``docs`` (all columns) as Parquet under ``path``, one folder
    ``shard=N`` per shard, and return it read back.  The rows are written once
    with their number first, so rows and shards belong together."""
    names = docs.columns
    fixed = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
                    .withColumn("n", F.monotonically_increasing_id()), "rows")
    got = assigned(fixed.select(F.col("n").alias("doc_id"), F.col("row.text").alias("text")), shards)
    out = fixed.join(got.select(F.col("doc_id").alias("n"), F.col("shard").alias("_shard"), "slot"), "n")
    # folders get a few files each: rows of a shard are dealt by slot
    (out.select("row.*", F.col("_shard").alias("shard")).repartition("shard", F.pmod(F.xxhash64("slot"), F.lit(8)))
     .write.partitionBy("shard").parquet(path))
    return docs.sparkSession.read.parquet(path)
