"""Replay a feed as a file stream: the feed is cut into time slices once (in
parallel), and the slices are released one after another, oldest first.  A
released slice is any number of files; the stream drains it as one micro-batch
and resumes from its checkpoint for the next one."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_SLICES = 4            # so that state crosses micro-batches on any data
SLICE_ROWS = 5_000_000      # rows of the event table behind one micro-batch, about


def time_bounds(df: DataFrame, ts: str = "ts"):
    """Min and max of the time column and the number of slices (three scalars)."""
    r = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    return r["lo"], r["hi"], max(LEAST_SLICES, math.ceil(r["n"] / SLICE_ROWS))


class Replay:
    """Slices of ``df`` under ``path``; ``release`` hands the next one to the stream."""

    def __init__(self, df: DataFrame, path: str, bounds, ts: str = "ts"):
        lo, hi, n = bounds
        self.spark: SparkSession = df.sparkSession
        self.schema, self.path, self.staged = df.schema, path, f"{path}-staged"
        span = (hi - lo) / n
        number = F.lit(n - 1)
        for i in range(n - 2, -1, -1):
            number = F.when(F.col(ts) < F.lit(lo + span * (i + 1)), i).otherwise(number)
        df.withColumn("slice", number).write.partitionBy("slice").parquet(self.staged)
        self.left = sorted(r["slice"] for r in self.spark.read.parquet(self.staged).select("slice").distinct().collect())
        if not self.left:
            df.limit(0).write.parquet(path)
        self.release()

    def release(self) -> bool:
        """Append the next slice to the stream's folder; False if none is left."""
        if not self.left:
            return False
        i = self.left.pop(0)
        self.spark.read.schema(self.schema).parquet(f"{self.staged}/slice={i}").write.mode("append").parquet(self.path)
        return True

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.path)
