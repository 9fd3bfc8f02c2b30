"""Two-level gather with idle timeouts (A4/A5 with the timers of both levels).

A building asks the groups of a query, every group asks its devices.  Both
levels gather by the same rule: a reply counts if it comes at most the idle
timeout after the request or the reply accepted before it, up to the expected
number.  A group answers its building when all its devices have, or when it has
been silent too long (with what it has, possibly nothing); the building answers
likewise over its groups.  Groups that do not exist never answer, a group without a
requested known device answers at once with an error item.

What a query gathers is bounded by its own document (one reply per requested
device), so a query's replies may meet in one row; repeated replies are reduced
to the first before that, with partial aggregation.  Folds are Column
expressions over the sorted replies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .envelopes import devices_of_groups
from .query import QUERY_KEY, query_known_devices

GROUP_SECONDS, BUILDING_SECONDS = 5, 10         # idle timeouts of the two levels
GROUP_KEY = [*QUERY_KEY, "group_pos"]
NO_GROUP = -1                                   # position of the one row of a query without groups


def _interval(seconds: float) -> Column:
    return F.make_dt_interval(secs=F.lit(float(seconds)))


def accepted(replies: Column, start: Column, expected: Column, timeout_s: float) -> Column:
    """Struct of the last accepted reply's time (``start`` if none) and the number of
    accepted ones of the sorted ``replies`` (structs with ``ts``): a prefix of them."""
    zero = F.struct(start.alias("last"), F.lit(0).cast("long").alias("n"), F.lit(False).alias("over"))

    def step(a: Column, r: Column) -> Column:
        silent = F.timestamp_diff("MICROSECOND", a["last"], r["ts"]) > int(timeout_s * 1_000_000)
        over = a["over"] | (a["n"] >= expected) | silent
        return F.struct(F.when(over, a["last"]).otherwise(r["ts"]).alias("last"),
                        F.when(over, a["n"]).otherwise(a["n"] + 1).alias("n"), over.alias("over"))
    return F.aggregate(replies, zero, step)


def asked_groups(qgroups: DataFrame, registry_df: DataFrame, groups: DataFrame) -> DataFrame:
    """Requested group rows (``explode_query_groups``) with whether the group exists at
    the query's time and how many replies it expects (its requested known devices)."""
    q = qgroups.select(*QUERY_KEY, "ts", F.coalesce("group_pos", F.lit(NO_GROUP)).cast("long").alias("group_pos"), "group", "devices")
    known = query_known_devices(devices_of_groups(q), registry_df).groupBy(*GROUP_KEY).agg(F.count(F.lit(1)).alias("expected"))
    g = groups.select("building", F.col("group_id").alias("group"), "created_ts")
    return (q.join(g, ["building", "group"], "left").join(known, GROUP_KEY, "left")
            .select(*GROUP_KEY, "ts", "group", F.coalesce(F.col("created_ts") <= F.col("ts"), F.lit(False)).alias("known"),
                    F.coalesce("expected", F.lit(0)).cast("long").alias("expected"),
                    F.coalesce(F.size("devices"), F.lit(0)).cast("long").alias("n_devices")))


def first_replies(replies: DataFrame) -> DataFrame:
    """The first reply of every asked device position."""
    return (replies.groupBy(*GROUP_KEY, "device_pos").agg(F.min(F.struct("ts", "text")).alias("r"))
            .select(*GROUP_KEY, "device_pos", "r.ts", "r.text"))


def two_level_gather(asked: DataFrame, replies: DataFrame, group_s: float = GROUP_SECONDS,
                     building_s: float = BUILDING_SECONDS) -> DataFrame:
    """Per query of ``asked`` (``asked_groups``): when it is answered and what with, given
    ``replies(GROUP_KEY, device_pos, ts, text)``.  Replies before their query, of
    positions that were not asked and with no time do not count; of repeated ones the
    first does.  Items stand in (group_pos, device_pos) order."""
    request = asked.select(*GROUP_KEY, F.col("ts").alias("_at"), "n_devices")
    first = first_replies(replies.join(request, GROUP_KEY).where("ts >= _at AND device_pos BETWEEN 0 AND n_devices - 1"))
    got = first.groupBy(*GROUP_KEY).agg(F.array_sort(F.collect_list(F.struct("ts", "device_pos", "text"))).alias("got"))
    g = asked.join(got, GROUP_KEY, "left").withColumn("got", F.coalesce("got", F.array().cast(got.schema["got"].dataType)))
    g = g.withColumn("a", accepted(F.col("got"), F.col("ts"), F.col("expected"), group_s))
    closes = (F.when(F.col("expected") == 0, F.col("ts")).when(F.col("a.n") == F.col("expected"), F.col("a.last"))
              .otherwise(F.col("a.last") + _interval(group_s)))
    item = lambda pos, text: F.struct(F.col("group_pos"), pos.cast("long").alias("device_pos"), text.alias("text"))      # noqa: E731
    error = F.concat(F.lit("error:"), F.col("group"), F.lit("::-"))
    items = F.when(F.col("expected") == 0, F.array(item(F.lit(None), error))).otherwise(
        F.transform(F.slice("got", F.lit(1), F.col("a.n").cast("int")), lambda r: item(r["device_pos"], r["text"])))
    answer = F.when(F.col("known"), F.struct(closes.alias("ts"), F.col("group_pos"), items.alias("items")))
    q = g.groupBy(*QUERY_KEY).agg(F.min("ts").alias("ts"), F.count("group").alias("expected_groups"),
                                  F.array_sort(F.collect_list(answer)).alias("answers"))
    q = q.withColumn("b", accepted(F.col("answers"), F.col("ts"), F.col("expected_groups"), building_s))
    complete = (F.col("b.n") == F.col("expected_groups")) & (F.col("expected_groups") > 0)
    of = F.array_sort(F.flatten(F.transform(F.slice("answers", F.lit(1), F.col("b.n").cast("int")), lambda x: x["items"])))
    return q.withColumn("of", of).select(
        *QUERY_KEY, F.when(complete, F.col("b.last")).otherwise(F.col("b.last") + _interval(building_s)).alias("answered_at"),
        "expected_groups", F.col("b.n").alias("received_groups"), complete.alias("complete"),
        F.size("of").cast("long").alias("n_items"), F.array_join(F.transform("of", lambda x: x["text"]), ";").alias("items"))


def device_attempts(requests: DataFrame, replies: DataFrame, timeout_s: float) -> DataFrame:
    """W5 with retries: an edge device asks to be registered until a reply tells it that
    it runs (REGISTERED / DEVICE ALREADY RUNNING); a request that no reply has
    answered ``timeout_s`` later has timed out, unless the device ran by then.  A
    late reply still counts.

    ``requests(event_id, ts, building, dev_id)`` as sent, readable or not, ids being
    unique; ``replies(event_id, ts, building, dev_id, status)`` carry the request's
    id.  One row per device that asked; devices are joined and aggregated only, never sorted whole."""
    device = ["building", "dev_id"]
    good = F.col("status").isin(K.REGISTERED, K.ALREADY_RUNNING)
    since = replies.where(good).groupBy(*device).agg(F.min("ts").alias("running_since"))
    answered = replies.groupBy("event_id").agg(F.min("ts").alias("answer_ts"))
    r = requests.join(answered, "event_id", "left").join(since, device, "left")
    deadline = F.col("ts") + _interval(timeout_s)
    tried = registering("ts")
    timed_out = tried & registering(deadline) & F.coalesce(F.col("answer_ts") > deadline, F.lit(True))
    sent = r.groupBy(*device).agg(F.min("ts").alias("first_request_ts"), F.first("running_since").alias("running_since"),
                                  F.count_if(tried).alias("n_attempts"), F.count_if(timed_out).alias("n_timeouts"))
    rejected = (replies.where(~good).join(since, device, "left").where(registering("ts"))
                .groupBy(*device).agg(F.count(F.lit(1)).alias("n_rejected")))
    return sent.join(rejected, device, "left").select(
        *device, "first_request_ts", "running_since", "n_attempts", F.coalesce("n_rejected", F.lit(0).cast("long")).alias("n_rejected"),
        "n_timeouts", state_of(F.col("running_since")).alias("state"))


def registering(at) -> Column:
    """Whether the device (with ``running_since``) is still registering at a time."""
    at = F.col(at) if isinstance(at, str) else at
    return F.col("running_since").isNull() | (at < F.col("running_since"))


def state_of(since: Column) -> Column:
    return F.when(since.isNull(), F.lit("registering")).otherwise(F.lit("running"))
