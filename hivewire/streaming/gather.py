"""T5: request/reply gathers with an idle timeout as a fold of micro-batches.

A gather is one row: its request's time, the last reply's (or the request's)
time, the replies accepted so far and whether it is closed.  A micro-batch joins
its replies with the open gathers; of a hot request's replies every salted part
keeps only as many as are still expected before they meet, so a task never
holds all of them.  The gaps between the few that are left tell how many are
accepted (as in W4), and event time tells which gathers have been silent too
long.  JVM only.

Event time is the newest row of any batch less ``lateness``.  Rows behind what it
was when their batch began are late: they are not gathered and go to a quarantine.
A closed gather stays as a marker (its request does not open another one) until
event time has passed it by ``ttl``, then the table drops it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import JobTable

SALTS = 16
LATENESS_SECONDS = 3600
TTL_SECONDS = 366 * 24 * 3600

GATHERS = "user_id LONG, request_ts TIMESTAMP_NTZ, last_ts TIMESTAMP_NTZ, accepted LONG, closed BOOLEAN"


def _seconds(s: float) -> Column:
    return F.make_dt_interval(secs=F.lit(float(s)))


class Gathers:
    """The gathers of a stream; ``fold`` takes a micro-batch of
    ``user_id, event_id, ts, event_type`` rows ('purchase' opens, 'view' replies,
    any other row only moves the time)."""

    def __init__(self, spark: SparkSession, path: str, expected: int, timeout_s: float, lateness_s: float = LATENESS_SECONDS,
                 ttl_s: float = TTL_SECONDS, salts: int = SALTS, **table):
        self.expected, self.timeout, self.lateness, self.ttl, self.salts = expected, timeout_s, lateness_s, ttl_s, salts
        self.table = JobTable(spark, f"{path}/gathers", GATHERS, ["user_id"], order=[], **table)
        self.clock = JobTable(spark, f"{path}/clock", "name STRING, newest TIMESTAMP_NTZ", ["name"], order=[])

    def first_replies(self, batch: DataFrame, open_: DataFrame) -> DataFrame:
        """The replies in the batch that an open gather may still take, numbered by time."""
        need = F.lit(self.expected) - F.col("accepted")
        part = F.pmod(F.xxhash64("event_id"), F.lit(self.salts))
        salted = open_.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(self.salts - 1).cast("long"))))
        r = (batch.where("event_type = 'view'").select("user_id", "event_id", "ts", part.alias("_salt"))
             .join(salted, ["user_id", "_salt"]).where("ts > request_ts"))
        rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("ts", "event_id"))     # noqa: E731
        r = r.withColumn("rn", rank("user_id", "_salt")).where(F.col("rn") <= need)
        return r.withColumn("rn", rank("user_id")).where(F.col("rn") <= need)

    def fold(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame, list]:
        """(gathers that close in this batch, late rows, writes of the state)."""
        before = self.clock.before(batch_id).first()        # one row
        newest = before["newest"] if before else None
        behind = F.lit(False) if newest is None else F.col("ts") < F.lit(newest).cast("timestamp_ntz") - _seconds(self.lateness)
        late, rows = batch.where(behind), batch.where(~behind)
        clock = batch.agg(F.max("ts").alias("n")).select(F.lit("clock").alias("name"), F.greatest(
            F.col("n"), F.lit(newest).cast("timestamp_ntz")).alias("newest")).where("newest IS NOT NULL").persist()
        now_row = clock.first()
        known = self.table.before(batch_id)
        opened = rows.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("request_ts")).join(
            known, "user_id", "left_anti").select("user_id", "request_ts", F.col("request_ts").alias("last_ts"),
                                                  F.lit(0).cast("long").alias("accepted"))
        open_ = known.where("NOT closed").drop("closed").withColumn("new", F.lit(False)).unionByName(
            opened.withColumn("new", F.lit(True)))
        w = Window.partitionBy("user_id").orderBy("ts", "event_id")
        r = self.first_replies(rows, open_.drop("new"))
        prev = F.greatest(F.col("last_ts"), F.coalesce(F.lag("ts").over(w), F.col("last_ts")))
        r = r.withColumn("gap", F.timestamp_diff("MICROSECOND", prev, F.col("ts")) > int(self.timeout * 1_000_000))
        r = r.withColumn("cut", F.max("gap").over(w))       # from the first gap too long on
        got = r.groupBy("user_id").agg(F.count_if(~F.col("cut")).alias("more"), F.max(F.when(~F.col("cut"), F.col("ts"))).alias("at"),
                                       F.max("cut").alias("late"))
        j = open_.join(got, "user_id", "left")
        accepted = F.col("accepted") + F.coalesce("more", F.lit(0))
        last = F.greatest(F.col("last_ts"), F.col("at"))
        j = j.select("user_id", "request_ts", last.alias("last_ts"), accepted.alias("accepted"), "new", F.col("more").isNotNull().alias("hit"),
                     F.coalesce("late", F.lit(False)).alias("late"))
        now = F.lit(now_row["newest"] if now_row else None).cast("timestamp_ntz")
        silent = F.coalesce(now - _seconds(self.lateness) > F.col("last_ts") + _seconds(self.timeout), F.lit(False))
        j = j.withColumn("closed", F.col("late") | (F.col("accepted") >= self.expected) | silent)
        changed = j.where("new OR hit OR closed").select("user_id", "request_ts", "last_ts", "accepted", "closed")
        done = changed.where("closed").select("user_id", "request_ts", "accepted", (F.col("accepted") == self.expected).alias("complete"))
        fresh = ~F.col("closed") | F.coalesce(F.col("last_ts") + _seconds(self.timeout + self.lateness + self.ttl) >= now, F.lit(True))
        return done, late, [(self.table, changed, fresh), (self.clock, clock)]
