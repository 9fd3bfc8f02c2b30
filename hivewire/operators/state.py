"""Per-device state rules and the idle-timeout gatherer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from .carry import DEFAULT_BUCKET_SECONDS, Carry, carry_forward
from .devices import crossing
from .latest import valid_readings
from .registry import DEVICE_KEY

REPLY_SALTS = 16        # parts that the replies to one request are dealt to


def battery_expected_status(telemetry: DataFrame, registry_df: DataFrame,
                            bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """The status a battery should report given its previous reading:
    discharging -> charging once a reading is <= 20, charging -> discharging
    once >= 80 (starting from 100 %, discharging)."""
    r = valid_readings(telemetry, registry_df).where(F.col("dev_type") == K.BATTERY).select(
        *DEVICE_KEY, "msg_offset", "ts", "percentage", "status")
    order = ["ts", "msg_offset"]
    r = carry_forward(r, DEVICE_KEY, order, [Carry("percentage", "_prev", inclusive=False)],
                      ts="ts", bucket_seconds=bucket_seconds, keep_bucket=True)
    prev = F.coalesce(F.col("_prev"), F.lit(K.BATTERY_INITIAL_PERCENTAGE))
    r = r.withColumn("prev_percentage", prev).withColumn("_cross", crossing(prev))
    r = carry_forward(r, DEVICE_KEY, order, [Carry("_cross", "_last")], ts="ts", bucket_seconds=bucket_seconds)
    exp = F.coalesce(F.col("_last"), F.lit(K.BATTERY_INITIAL_STATUS))
    return r.select(*DEVICE_KEY, "msg_offset", "ts", "percentage", "status", "prev_percentage",
                    exp.alias("expected_status"), (F.col("status") == exp).alias("matches"))


def gather_idle_cutoff(requests: DataFrame, replies: DataFrame, expected: int,
                       timeout_seconds: float, key: str = "user_id", salts: int = REPLY_SALTS) -> DataFrame:
    """Replies to a request are accepted until ``expected`` arrived or the
    first idle gap (since the request or the previous reply) exceeds the
    timeout.  Only the first ``expected`` replies matter.  A request's replies
    are dealt to ``salts`` parts by their event id (the requests, one row per
    key, are repeated per part); every part keeps its first ``expected``, so at
    most ``salts * expected`` replies of a key meet in one task."""
    part = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    r = (replies.withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(salts)))
         .join(requests.withColumn("_salt", F.explode(part)), [key, "_salt"])
         .where(F.col("ts") > F.col("request_ts")))
    order = ["ts", "event_id"]
    r = r.withColumn("rn", F.row_number().over(Window.partitionBy(key, "_salt").orderBy(*order))).where(F.col("rn") <= expected)
    w = Window.partitionBy(key).orderBy(*order)
    first = r.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= expected)
    gap = F.timestamp_diff("MICROSECOND", F.coalesce(F.lag("ts").over(w), F.col("request_ts")), F.col("ts")) / 1e6
    first = first.withColumn("late", gap > timeout_seconds)
    agg = (first.groupBy(key)
           .agg(F.min(F.when(F.col("late"), F.col("rn"))).alias("first_late"),
                F.count(F.lit(1)).alias("n_first")))
    accepted = F.coalesce(F.col("first_late") - 1, F.col("n_first")).cast("long")
    out = (requests.join(agg, key, "left")
           .withColumn("accepted", F.coalesce(accepted, F.lit(0).cast("long"))))
    return out.select(key, "request_ts", "accepted", (F.col("accepted") == expected).alias("complete"))
