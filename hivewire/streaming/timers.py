"""Event-time timers of micro-batches: two-level gathers (A4/A5) and registration
attempts with deadlines (W5).

Event time is the newest row of any batch less a lateness.  A job keeps what is
still open in ``JobTable``s, computes the batch operator over it, and emits only
what event time has passed: nothing that arrives later (within the lateness) can
change it, so every result is emitted once and is the batch operator's,
wherever the micro-batches are cut.  JVM only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import nested as N
from ..operators.query import QUERY_KEY
from .tables import JobTable

LATENESS_SECONDS = 60


class Clock:
    """Event time before and after a micro-batch (``None`` before the first row)."""

    def __init__(self, spark: SparkSession, path: str, lateness_s: float):
        self.spark, self.lateness = spark, dt.timedelta(seconds=lateness_s)
        self.table = JobTable(spark, f"{path}/clock", "name STRING, newest TIMESTAMP_NTZ", ["name"], order=[])

    def see(self, batch: DataFrame, batch_id: int) -> tuple:
        earlier = self.table.before(batch_id).first()               # one row
        earlier = earlier["newest"] if earlier else None
        newest = max((t for t in (earlier, batch.agg(F.max("ts").alias("t")).first()["t"]) if t), default=None)
        rows = [] if newest is None else [("clock", newest)]
        self.addition = (self.table, self.spark.createDataFrame(rows, "name STRING, newest TIMESTAMP_NTZ"))
        return tuple(t and t - self.lateness for t in (earlier, newest))


def _time(t: dt.datetime | None) -> Column:
    return F.lit(t).cast("timestamp_ntz")


def _passed(at: str, now: dt.datetime | None) -> Column:
    """Whether event time ``now`` has passed a time."""
    return F.coalesce(F.col(at) < _time(now), F.lit(False))


_ASKED = ("event_id LONG, building STRING, query_id STRING, group_pos LONG, ts TIMESTAMP_NTZ, `group` STRING, known BOOLEAN, "
          "expected LONG, n_devices LONG, closed BOOLEAN")
_REPLIES = ("event_id LONG, building STRING, query_id STRING, group_pos LONG, device_pos LONG, ts TIMESTAMP_NTZ, text STRING, "
            "closed BOOLEAN")


class NestedGathers:
    """Open queries with their requested groups, and the first replies that belong to
    them or may belong to a query that has yet to arrive.  Replies that event
    time has passed without an open query (of answered queries, or of none, or of
    positions that were not asked) go to a quarantine."""

    def __init__(self, spark: SparkSession, path: str, group_s: float = N.GROUP_SECONDS, building_s: float = N.BUILDING_SECONDS,
                 lateness_s: float = LATENESS_SECONDS, **table):
        self.group_s, self.building_s = group_s, building_s
        self.clock = Clock(spark, path, lateness_s)
        self.asked = JobTable(spark, f"{path}/asked", _ASKED, N.GROUP_KEY, order=[], **table)
        self.replies = JobTable(spark, f"{path}/replies", _REPLIES, [*N.GROUP_KEY, "device_pos"], order=[], **table)

    def fold(self, batch: DataFrame, asked: DataFrame, replies: DataFrame, batch_id: int, keep=lambda df: df) -> tuple:
        """(queries answered by now, replies without a query, writes of the state); the batch
        brings new ``asked`` and ``replies`` rows and, all its rows, the time.  ``keep``
        may hold on to a result that is used more than once."""
        _, now = self.clock.see(batch, batch_id)
        flag = lambda df, new: df.withColumn("new", F.lit(new))         # noqa: E731
        open_ = keep(flag(self.asked.before(batch_id).where("NOT closed").drop("closed"), False).unionByName(flag(asked, True)))
        cols = [*N.GROUP_KEY, "device_pos", "ts", "text"]
        both = flag(self.replies.before(batch_id).where("NOT closed").select(*cols), False).unionByName(
            flag(replies.select(*cols), True))
        first = keep(both.groupBy(*N.GROUP_KEY, "device_pos").agg(F.min(F.struct("ts", "text")).alias("r"), F.max("new").alias("new"))
                     .select(*N.GROUP_KEY, "device_pos", "r.*", "new"))
        done = keep(N.two_level_gather(open_, first, self.group_s, self.building_s).where(_passed("answered_at", now)))
        ended = done.select(*QUERY_KEY, F.lit(True).alias("ended"))
        owner = open_.select(*N.GROUP_KEY, "n_devices").join(ended, QUERY_KEY, "left")
        r = first.join(owner, N.GROUP_KEY, "left")
        belongs = F.coalesce(F.col("device_pos").between(0, F.col("n_devices") - 1), F.lit(False))
        r = r.withColumn("stray", ~belongs & _passed("ts", now))
        r = keep(r.withColumn("closed", F.col("stray") | (belongs & F.col("ended").isNotNull())))
        o = open_.join(ended, QUERY_KEY, "left").withColumn("closed", F.col("ended").isNotNull())
        return done, r.where("stray").select(*cols), [
            (self.asked, o.where("new OR closed"), ~F.col("closed")), (self.replies, r.where("new OR closed"), ~F.col("closed")),
            self.clock.addition]


_MESSAGES = "kind STRING, event_id LONG, ts TIMESTAMP_NTZ, building STRING, dev_id STRING, status STRING"
_DEVICES = ("building STRING, dev_id STRING, first_request_ts TIMESTAMP_NTZ, running_since TIMESTAMP_NTZ, n_attempts LONG, "
            "n_rejected LONG, n_timeouts LONG")
_TIMERS = "event_id LONG, building STRING, dev_id STRING, deadline TIMESTAMP_NTZ, open BOOLEAN"
DEVICE = ["building", "dev_id"]


class Attempts:
    """Devices that register, retry and run (``device_attempts`` as a state machine).

    Requests and replies wait until event time has passed them, so they take effect in time order;
    an attempt sets a timer, which its reply or the device's running stops and
    which fires when event time has passed the deadline.  Messages from before
    what event time was when their batch began are late and go to a quarantine."""

    def __init__(self, spark: SparkSession, path: str, timeout_s: float, lateness_s: float = LATENESS_SECONDS, **table):
        self.timeout = timeout_s
        self.clock = Clock(spark, path, lateness_s)
        self.waiting = JobTable(spark, f"{path}/waiting", _MESSAGES, ["kind", "event_id"], order=[], **table)
        self.devices = JobTable(spark, f"{path}/devices", _DEVICES, DEVICE, order=[], **table)
        self.timers = JobTable(spark, f"{path}/timers", _TIMERS, ["event_id"], order=[], **table)

    def fold(self, batch: DataFrame, messages: DataFrame, batch_id: int, keep=lambda df: df) -> tuple:
        """(transitions, late messages, writes of the state); ``messages`` are
        ``kind ('request' or 'reply'), event_id, ts, building, dev_id, status``."""
        before, now = self.clock.see(batch, batch_id)
        behind = _passed("ts", before)
        late, timely = messages.where(behind), messages.where(~behind)
        due = keep(self.waiting.before(batch_id).where(~_passed("ts", before)).unionByName(timely).where(_passed("ts", now)))
        requests, replies = due.where("kind = 'request'"), due.where("kind = 'reply'")
        good = F.col("status").isin(K.REGISTERED, K.ALREADY_RUNNING)
        known = self.devices.before(batch_id)
        ran = replies.where(good).groupBy(*DEVICE).agg(F.min("ts").alias("starts"))
        since = keep(known.select(*DEVICE, F.col("running_since").alias("earlier")).join(ran, DEVICE, "full")
                     .withColumn("running_since", F.coalesce("earlier", "starts")))
        deadline = (F.col("ts") + F.make_dt_interval(secs=F.lit(float(self.timeout)))).alias("deadline")
        tried = requests.join(since, DEVICE, "left").where(N.registering("ts")).select("event_id", *DEVICE, deadline)
        set_ = self.timers.before(batch_id).where("open").select("event_id", *DEVICE, "deadline", F.lit(False).alias("new")).unionByName(
            tried.withColumn("new", F.lit(True)))
        answers = replies.groupBy("event_id").agg(F.min("ts").alias("answer_ts"))
        t = set_.join(answers, "event_id", "left").join(since, DEVICE, "left")
        stopped = F.coalesce(F.col("answer_ts") <= F.col("deadline"), F.lit(False)) | ~N.registering("deadline")
        fires = ~stopped & _passed("deadline", now)
        t = keep(t.withColumn("fires", fires).withColumn("open", ~stopped & ~fires))
        rejected = replies.where(~good).join(since, DEVICE, "left").where(N.registering("ts"))
        one = lambda df, what: df.select(*DEVICE, *[F.lit(int(w == what)).cast("long").alias(w) for w in (      # noqa: E731
            "n_attempts", "n_rejected", "n_timeouts")], (F.col("ts") if what == "n_requests" else F.lit(None).cast("timestamp_ntz")).alias("at"))
        counted = (one(requests, "n_requests").unionByName(one(tried, "n_attempts")).unionByName(one(rejected, "n_rejected"))
                   .unionByName(one(t.where("fires"), "n_timeouts")).groupBy(*DEVICE).agg(
                       F.min("at").alias("at"), *[F.sum(w).alias(f"+{w}") for w in ("n_attempts", "n_rejected", "n_timeouts")]))
        plus = lambda w: (F.coalesce(w, F.lit(0)) + F.coalesce(f"+{w}", F.lit(0))).cast("long").alias(w)        # noqa: E731
        touched = counted.join(ran, DEVICE, "full").join(known.drop("running_since"), DEVICE, "left").join(
            since.select(*DEVICE, "running_since"), DEVICE, "left")
        devices = touched.select(*DEVICE, F.least("first_request_ts", "at").alias("first_request_ts"), "running_since",
                                 plus("n_attempts"), plus("n_rejected"), plus("n_timeouts"))
        started = since.where("earlier IS NULL AND starts IS NOT NULL")
        event = lambda df, what, at, key: df.select(*DEVICE, F.lit(what).alias("transition"), F.col(at).alias("at"),        # noqa: E731
                                                    key.cast("long").alias("event_id"))
        transitions = event(started, "running", "starts", F.lit(None)).unionByName(
            event(rejected, "rejected", "ts", F.col("event_id"))).unionByName(
            event(t.where("fires"), "timed out", "deadline", F.col("event_id")))
        return transitions, late, [
            (self.devices, devices), (self.timers, t.where("new OR NOT open"), F.col("open")),
            (self.waiting, timely.where(~_passed("ts", now)), ~_passed("ts", now)), self.clock.addition]

    def current(self) -> DataFrame:
        """The devices that asked, as ``device_attempts`` gives them."""
        d = self.devices.current().where("first_request_ts IS NOT NULL")
        return d.withColumn("state", N.state_of(F.col("running_since")))
