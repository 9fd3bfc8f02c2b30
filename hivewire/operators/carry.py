"""Carry-forward (running "last non-null", sum, min or max) per key, split by time bucket.

The closed form of most per-device folds here is ``last(x, ignoreNulls)``
(or another associative merge) over the rows of a key ordered by time.  A plain window partitions by the
key, so one hot device (a third of all rows, say) would be sorted and
scanned by one task.  Instead the rows are cut into (key, time bucket)
partitions:

1. per (key, bucket): the merged value of the bucket -- an
   aggregation with a map-side partial step;
2. per key, over those bucket summaries (one row per bucket that has rows):
   the merged value of all *earlier* buckets -- a small window;
3. per (key, bucket): a window over the bucket's own rows, falling back to
   the carried-in value.

Step 3 joins the step-2 table on (key, bucket), one row per (key, bucket), so
no row multiplies, and the window reuses the join's partitioning.  The largest
task holds one bucket of one key.

Bucket width.  By default a fixed 60 s: a device holding a third of 100 TB
over a month puts ~0.8 GB in one task, and step 2 sees at most one summary
per device-minute (~43k per device-month, far fewer rows than the log for a
busy device).  ``bucket_seconds=None`` instead picks a width per key from its
own row count and span so that a bucket holds ~``target_rows`` rows; that
costs one more pass over the input, so use it on materialised inputs.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPOCH = _dt.datetime(1970, 1, 1)
DEFAULT_BUCKET_SECONDS = 60        # None: adaptive width per key
DEFAULT_TARGET_ROWS = 1_000_000


@dataclass(frozen=True)
class Carry:
    value: str            # column carried forward (any type, NULL = no value)
    out: str              # output column
    inclusive: bool = True  # include the current row (False: strictly earlier rows)
    how: str = "last"     # how values merge: last non-null, or sum, min, max of the non-null ones

    def summary(self, order: str) -> Column:
        """The values of a group of rows as one."""
        v = F.col(self.value)
        if self.how == "last":
            return F.max_by(v, F.when(v.isNotNull(), F.col(order)))
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.how](v)

    def over(self, value: str, window) -> Column:
        """The values of a window frame as one."""
        if self.how == "last":
            return F.last(value, ignorenulls=True).over(window)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.how](F.col(value)).over(window)

    def merge(self, earlier: Column, later: Column) -> Column:
        """Two adjacent runs as one; NULL is the empty run."""
        if self.how == "last":
            return F.coalesce(later, earlier)
        if self.how == "sum":
            return F.coalesce(earlier + later, later, earlier)
        return (F.least if self.how == "min" else F.greatest)(earlier, later)


def epoch_seconds(ts: str) -> Column:
    """Seconds since 1970-01-01 of a wall-clock time, independent of the session
    time zone (no DST jumps for TIMESTAMP_NTZ)."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH), F.col(ts))


def time_bucket(ts: str, bucket_seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(bucket_seconds)).cast("long")


def adaptive_width(df: DataFrame, keys: list[str], ts: str, target_rows: int) -> DataFrame:
    """Per key: bucket width in seconds so that a bucket holds ~``target_rows``."""
    secs = epoch_seconds(ts)
    stats = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(secs).alias("_lo"), F.max(secs).alias("_hi"))
    width = F.greatest(F.lit(1), F.ceil((F.col("_hi") - F.col("_lo") + 1) * F.lit(target_rows) / F.col("_n")))
    return stats.select(*keys, width.cast("long").alias("_cf_width"))


BUCKET = "_cf_bucket"


def carry_forward(df: DataFrame, keys: list[str], order: list[str], carries: list[Carry],
                  ts: str, bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                  target_rows: int = DEFAULT_TARGET_ROWS, keep_bucket: bool = False) -> DataFrame:
    """Adds one column per ``Carry``: the last non-null ``value`` of the key's
    rows ordered by ``order`` (first element must be the time column ``ts``).

    ``keep_bucket`` keeps the bucket column; a following carry over the same
    keys then reuses it, and since the rows are already hash-partitioned by
    (keys, bucket) only its small summary side is shuffled."""
    b, o = BUCKET, "_cf_order"
    if b in df.columns:
        d = df
    elif bucket_seconds is None:
        d = df.join(adaptive_width(df, keys, ts, target_rows), keys, "left")
        secs = epoch_seconds(ts)
        d = d.withColumn(b, F.floor(secs / F.col("_cf_width")).cast("long")).drop("_cf_width")
    else:
        d = df.withColumn(b, time_bucket(ts, bucket_seconds))
    d = d.withColumn(o, F.struct(*order))
    # 1. merged value of every bucket (NULL when the bucket has none)
    summaries = d.groupBy(*keys, b).agg(*[c.summary(o).alias(f"_cf_last{i}") for i, c in enumerate(carries)])
    # 2. value carried into each bucket from the earlier buckets of the key
    before = Window.partitionBy(*keys).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    carried_in = summaries.select(*keys, b, *[
        c.over(f"_cf_last{i}", before).alias(f"_cf_in{i}") for i, c in enumerate(carries)])
    # 3. within the bucket, fall back to the carried-in value
    j = d.join(carried_in, [*keys, b], "left")
    within = Window.partitionBy(*keys, b).orderBy(*order)
    out = j
    for i, c in enumerate(carries):
        frame = within.rowsBetween(Window.unboundedPreceding, 0 if c.inclusive else -1)
        out = out.withColumn(c.out, c.merge(F.col(f"_cf_in{i}"), c.over(c.value, frame)))
    out = out.drop(o, *[f"_cf_in{i}" for i in range(len(carries))])
    return out if keep_bucket else out.drop(b)
