"""Readings of registered devices and their latest values.

Latest means arrival order: (ts, msg_offset) of the log, never the payload
timestamp.  Every "last/first per key" here is a ``max_by``/``min_by``
aggregation, which Spark pre-aggregates before the shuffle, so a hot topic
costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import json as J
from .decode import decode_by_type, encode_by_type, reading_columns
from .devices import DEFAULT_REGISTRY, Registry
from .registry import DEVICE_KEY

ARRIVAL = ("ts", "msg_offset")


def telemetry_of_registered(telemetry: DataFrame, registry_df: DataFrame) -> DataFrame:
    """Inner equi-join reading.topic = registry.module_path (supplies the type).

    The registry has one row per device and is joined on the topic; AQE
    broadcasts it when its measured size is small and otherwise keeps a
    shuffled join (split on skewed topics)."""
    reg = registry_df.select(*DEVICE_KEY, "dev_type", F.col("module_path").alias("topic"),
                             "reg_ts", "reg_event_id")
    return telemetry.join(reg, "topic")


def replay_since_registration(telemetry: DataFrame, registry_df: DataFrame) -> DataFrame:
    """What a device's subscription delivers: the retained message at its
    registration (the last one with ts <= reg_ts) plus every later message.

    The retained message is a ``max_by`` aggregation per registration, the
    later ones a filter; no window over the topic."""
    return since_registration(telemetry_of_registered(telemetry, registry_df))


def since_registration(j: DataFrame) -> DataFrame:
    """J3 over readings of registered devices (J2), decoded or not."""
    later = j.where(F.col("ts") > F.col("reg_ts")).withColumn("retained", F.lit(False))
    cols = [c for c in j.columns if c not in (*DEVICE_KEY, "reg_ts")]
    retained = (j.where(F.col("ts") <= F.col("reg_ts"))
                .groupBy(*DEVICE_KEY, "reg_ts")
                .agg(F.max_by(F.struct(*cols), F.struct(*ARRIVAL)).alias("m"))
                .select(*DEVICE_KEY, "reg_ts", "m.*")
                .withColumn("retained", F.lit(True)))
    return later.unionByName(retained)


def decoded_readings(telemetry: DataFrame, registry_df: DataFrame,
                     registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Readings of registered devices (J2) decoded by device type, with ``reason``
    (NULL = valid).  A job that uses them more than once persists this and hands
    it on as ``decoded``, so that a message is parsed once."""
    return decode_by_type(telemetry_of_registered(telemetry, registry_df), "dev_type", "payload", registry)


def delivered_readings(telemetry: DataFrame, registry_df: DataFrame,
                       registry: Registry = DEFAULT_REGISTRY, decoded: DataFrame | None = None) -> DataFrame:
    """J3 rows decoded by device type, with ``reason`` (NULL = valid)."""
    if decoded is not None:
        return since_registration(decoded)
    return decode_by_type(replay_since_registration(telemetry, registry_df), "dev_type", "payload", registry)


def valid_readings(telemetry: DataFrame, registry_df: DataFrame,
                   registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Valid readings of registered devices, whole log (the device's own states)."""
    return decoded_readings(telemetry, registry_df, registry).where("reason IS NULL").drop("reason")


def latest_per_device(telemetry: DataFrame, registry_df: DataFrame,
                      registry: Registry = DEFAULT_REGISTRY, decoded: DataFrame | None = None) -> DataFrame:
    """A3: last valid delivered reading per registered device (arrival order)."""
    return latest_of(delivered_readings(telemetry, registry_df, registry, decoded).where("reason IS NULL"), registry)


def latest_of(valid: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """A3 over valid delivered readings: the columns of the registry's types."""
    payload = F.struct("msg_offset", "ts", *reading_columns(registry))
    return (valid.groupBy(*DEVICE_KEY, "dev_type")
            .agg(F.max_by(payload, F.struct(*ARRIVAL)).alias("m"))
            .select(*DEVICE_KEY, "dev_type", "m.*"))


def latest_json(latest: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """P4 applied to A3: the canonical JSON a device answers with."""
    return latest.withColumn("json", encode_by_type(latest, "dev_type", registry))


def retained_snapshot(log: DataFrame) -> DataFrame:
    """The last message per topic (what a new subscriber receives)."""
    return (log.groupBy("topic")
            .agg(F.max_by(F.struct("msg_offset", "ts", "payload"), F.struct(*ARRIVAL)).alias("m"))
            .select("topic", "m.*"))


def first_message_per_topic(log: DataFrame) -> DataFrame:
    """L1: the first message per topic."""
    return (log.groupBy("topic")
            .agg(F.min_by(F.struct("msg_offset", "ts", "payload"), F.struct(*ARRIVAL)).alias("m"))
            .select("topic", "m.*"))


def subscribe_topics(log: DataFrame, topics: DataFrame | list[str]) -> DataFrame:
    """Keep messages of an exact set of topics (no wildcards).

    A literal list becomes an ``isin`` filter (pushed to the scan); a topic
    table becomes a left-semi join, never collected to the driver."""
    if isinstance(topics, (list, tuple)):
        return log.where(F.col("topic").isin(*topics))
    return log.join(topics.select("topic").distinct(), "topic", "left_semi")


def encode_telemetry(telemetry: DataFrame, registry_df: DataFrame,
                     registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """P4 / T1 output: valid delivered readings -> canonical JSON on Data-{building};
    a missing or non-finite number is written as JSON null; a row that does
    not encode at all (no encoder for its type) is dropped."""
    return published(delivered_readings(telemetry, registry_df, registry), registry)


def published(delivered: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """P4 over decoded delivered readings (batch and stream)."""
    d = delivered.where("reason IS NULL")
    return (J.once(d, encode_by_type(d, "dev_type", registry).alias("json"))
            .where("json IS NOT NULL")
            .withColumn("out_topic", F.concat(F.lit(K.DATA_PREFIX + "-"), F.col("building"))))
