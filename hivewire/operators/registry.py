"""Device and building registries.

First-valid-wins is an aggregation (``min_by`` over (ts, event_id)) with a
map-side partial step, and per-request statuses join that one-row-per-key
result back to the requests.  No window is partitioned by device, so a hot
device never lands whole in one task (AQE's skew join splits the request
side of the join-back).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import topics as T
from .decode import decode_register, filter_known_types, split
from .devices import DEFAULT_REGISTRY, Registry

DEVICE_KEY = ["building", "group_id", "dev_id"]
START = dt.datetime(1, 1, 1)        # before any message


def decoded_requests(requests: DataFrame) -> DataFrame:
    """Good registration rows (all four members are strings)."""
    good, _ = split(decode_register(requests))
    return good


def device_registry(requests: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """A1: first valid request per (building, group, device) -> registry row
    with the registration instant (reg_ts, reg_event_id)."""
    return registry_of(decoded_requests(requests), registry)


def registry_of(decoded: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """A1 over already decoded (good) registration rows."""
    ok = filter_known_types(decoded, registry).where("accepted")
    first = F.min_by(F.struct("ts", "event_id", "dev_type", "module_path"), F.struct("ts", "event_id"))
    return (ok.groupBy(*DEVICE_KEY).agg(first.alias("r"))
            .select(*DEVICE_KEY, "r.dev_type", "r.module_path",
                    F.col("r.ts").alias("reg_ts"), F.col("r.event_id").alias("reg_event_id")))


def list_groups(requests: DataFrame) -> DataFrame:
    """A2: groups exist from their first mention by any decoded request,
    even when that request's device is rejected."""
    return groups_of(decoded_requests(requests))


def groups_of(decoded: DataFrame) -> DataFrame:
    """A2 over already decoded (good) registration rows."""
    return decoded.groupBy("building", "group_id").agg(F.min("ts").alias("created_ts"))


def registration_status(requests: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Per decoded request, the reply text and its topic.

    Before the first valid request of a key every request is invalid
    (COULD NOT CREATE ...); the first valid one is REGISTERED; every later
    one, valid or not, is DEVICE ALREADY RUNNING.
    """
    return statuses_of(decoded_requests(requests), registry)


def statuses_of(req: DataFrame, registry: Registry = DEFAULT_REGISTRY, reg_df: DataFrame | None = None) -> DataFrame:
    """W1 over already decoded (good) registration rows."""
    reg = (reg_df if reg_df is not None else registry_of(req, registry)).select(*DEVICE_KEY, "reg_ts", "reg_event_id")
    j = req.join(reg, DEVICE_KEY, "left")
    at = F.struct("ts", "event_id")
    first = F.struct(F.col("reg_ts").alias("ts"), F.col("reg_event_id").alias("event_id"))
    status = (F.when(F.col("reg_ts").isNull() | (at < first), F.lit(K.COULD_NOT_CREATE + K.INVALID_DEVICE_NAME))
              .when(at == first, F.lit(K.REGISTERED))
              .otherwise(F.lit(K.ALREADY_RUNNING)))
    return j.select("event_id", "ts", *DEVICE_KEY, "dev_type",
                    T.register_reply_topic(F.col("building"), F.col("dev_id")).alias("reply_topic"),
                    status.alias("status"))


def device_lifecycle(requests: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """An edge device (building, dev_id) listens on its reply topic and is
    running from the first reply REGISTERED / DEVICE ALREADY RUNNING."""
    st = registration_status(requests, registry)
    good = F.col("status").isin(K.REGISTERED, K.ALREADY_RUNNING)
    return (st.groupBy("building", "dev_id", "reply_topic")
            .agg(F.min("ts").alias("first_request_ts"),
                 F.min(F.when(good, F.col("ts"))).alias("running_since"),
                 F.count(F.lit(1)).alias("n_replies"),
                 F.count(F.when(~good, F.lit(1))).alias("n_rejected"))
            .withColumn("state", F.when(F.col("running_since").isNull(), F.lit("registering"))
                        .otherwise(F.lit("running"))))


def build_topic_paths(reg: DataFrame) -> DataFrame:
    """Every topic name derived from a registry row."""
    b = F.col("building")
    return reg.select(
        *DEVICE_KEY, "dev_type",
        F.col("module_path").alias("reading_topic"),
        T.command_topic(F.col("module_path")).alias("command_topic"),
        T.register_topic(b).alias("register_topic"),
        T.register_reply_topic(b, F.col("dev_id")).alias("register_reply_topic"),
        T.kafka_topic(K.DATA_PREFIX, b).alias("data_topic"),
        T.kafka_topic(K.QUERY_PREFIX, b).alias("query_topic"),
        T.kafka_topic(K.COMMAND_PREFIX, b).alias("command_kafka_topic"),
        T.kafka_topic(K.QUERY_RESULTS_PREFIX, b).alias("query_results_topic"))


# --- region level -----------------------------------------------------------

def list_buildings(buildings: DataFrame) -> DataFrame:
    """Distinct building ids per region."""
    return buildings.select("region", "building").distinct()


def merge_building_registry(seed: DataFrame, requests: DataFrame) -> DataFrame:
    """Building registration requests against a region's registry.

    A request succeeds iff its building is not seeded in that region and it
    is the first request for it; every other request gets 'already
    registered'.  Returns one status row per request.
    """
    key = ["region", "building"]
    first = (requests.groupBy(*key)
             .agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event_id")))
    seeded = seed.select(*key).distinct().withColumn("seeded", F.lit(True))
    j = requests.join(first, key, "left").join(seeded, key, "left")
    ok = F.col("seeded").isNull() & (F.col("event_id") == F.col("first_event_id"))
    msg = F.concat(F.lit(K.BUILDING_PREFIX), F.col("building"),
                   F.when(ok, F.lit(K.BUILDING_REGISTERED)).otherwise(F.lit(K.BUILDING_ALREADY)))
    return j.select("event_id", "ts", *key, ok.alias("ok"), msg.alias("message"))


def merged_buildings(seed: DataFrame, requests: DataFrame) -> DataFrame:
    """The registry after U2: seed plus successfully registered buildings."""
    added = merge_building_registry(seed, requests).where("ok").select("building", "region")
    return seed.select("building", "region").unionByName(added)


def building_instants(seed: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """``building, since``: seeded buildings since ever, others (U2) since their first request."""
    out = seed.select("building", F.lit(START).cast("timestamp_ntz").alias("since")).distinct()
    if requests is None:
        return out
    first = requests.groupBy("building").agg(F.min("ts").alias("since"))
    return out.unionByName(first.join(out, "building", "left_anti"))
