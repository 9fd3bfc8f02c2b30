"""Query answering.

A building query names groups and device ids.  State is taken as of the
query's own time ``ts``: a device is known if it registered at or before it,
a group exists if it was first mentioned at or before it, and a device's
value is its latest valid delivered reading at or before it.  The as-of value
lookup is a carry-forward over the union of readings and query rows (see
``carry``), never a range join or a join that pairs every reading with every
query.  Result lists are gathered per query; one list is bounded by its own
document.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .carry import DEFAULT_BUCKET_SECONDS, Carry, carry_forward
from .decode import encode_by_type, reading_columns
from .devices import DEFAULT_REGISTRY, Registry
from .envelopes import QUERY_BODY, devices_of_groups, explode_envelope, route_to_registered_buildings
from .latest import delivered_readings
from .registry import DEVICE_KEY

QUERY_KEY = ["event_id", "building", "query_id"]


def routed_queries(queries_raw: DataFrame, buildings: DataFrame) -> DataFrame:
    """P6 -> A8 -> J1: building query entries of good documents, last entry of a
    repeated building wins, unknown buildings dropped."""
    return route_to_registered_buildings(explode_envelope(queries_raw, QUERY_BODY, last_wins=True), buildings)


def query_known_devices(devices: DataFrame, registry_df: DataFrame) -> DataFrame:
    """Requested devices registered in the group at query time (duplicates kept)."""
    reg = registry_df.select(F.col("building"), F.col("group_id").alias("group"),
                             F.col("dev_id").alias("device"), "dev_type", "reg_ts")
    return (devices.where("device IS NOT NULL")
            .join(reg, ["building", "group", "device"])
            .where(F.col("reg_ts") <= F.col("ts")).drop("reg_ts"))


def _existing(groups_df: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    g = groups.select(F.col("building").alias("_gb"), F.col("group_id").alias("_g"),
                      F.col("created_ts").alias("_gts"), *[c for c in groups.columns if c.startswith("_")])
    cond = ((groups_df.building == g._gb) & (groups_df.group == g._g) & (g._gts <= groups_df.ts))
    return groups_df.join(g, cond, how).drop("_gb", "_g", "_gts")


def query_unknown_groups(query_groups: DataFrame, groups: DataFrame) -> DataFrame:
    """Requested groups that do not exist at query time (no reply for them)."""
    return _existing(query_groups.where("group IS NOT NULL"), groups, "left_anti")


def asked_readings(telemetry: DataFrame, known: DataFrame, registry_df: DataFrame,
                   registry: Registry = DEFAULT_REGISTRY, decoded: DataFrame | None = None) -> DataFrame:
    """Valid delivered readings of the devices that ``known`` (J4) asks about:
    the registry (or what is ``decoded`` of it) is cut to them first, so only messages of their topics are
    joined, decoded and sorted."""
    asked = known.select("building", F.col("group").alias("group_id"), F.col("device").alias("dev_id")).distinct()
    if decoded is None:
        registry_df = registry_df.join(asked, DEVICE_KEY, "left_semi")
    else:
        decoded = decoded.join(asked, DEVICE_KEY, "left_semi")
    return delivered_readings(telemetry, registry_df, registry, decoded).where("reason IS NULL").drop("reason")


def query_latest_values(known: DataFrame, delivered_valid: DataFrame,
                        registry: Registry = DEFAULT_REGISTRY,
                        bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Each known requested device with its latest valid delivered reading
    at query time (``delivered_valid``: valid rows of ``delivered_readings``);
    ``json`` is the reply ("NO DATA YET" when none)."""
    readings = (delivered_valid
                .select(*DEVICE_KEY, "ts", F.lit(0).alias("_kind"), F.col("msg_offset").alias("_seq"),
                        F.struct("msg_offset", "ts", *reading_columns(registry)).alias("_reading")))
    q = known.withColumnRenamed("group", "group_id").withColumnRenamed("device", "dev_id")
    asks = q.select(*DEVICE_KEY, "ts", F.lit(1).alias("_kind"), F.col("event_id").alias("_seq"),
                    F.lit(None).alias("_reading"),
                    F.struct(*[c for c in q.columns]).alias("_ask"))
    both = readings.unionByName(asks, allowMissingColumns=True)
    cf = carry_forward(both, DEVICE_KEY, ["ts", "_kind", "_seq"],
                       [Carry("_reading", "_latest")], ts="ts", bucket_seconds=bucket_seconds)
    out = cf.where("_kind = 1").select("_ask.*", "_latest")
    r = F.col("_latest")
    out = out.select(*q.columns,
                     r.msg_offset.alias("reading_offset"), r.ts.alias("reading_ts"),
                     *[r.getField(c).alias(c) for c in reading_columns(registry)])
    data = encode_by_type(out, "dev_type", registry)
    no_data = F.to_json(F.struct(F.col("dev_id").alias("deviceId"), F.lit(K.NO_DATA_YET).alias("data")))
    return (out.withColumn("json", F.when(F.col("reading_offset").isNull(), no_data).otherwise(data))
            .withColumnRenamed("group_id", "group").withColumnRenamed("dev_id", "device"))


def query_replies(qgroups: DataFrame, delivered_valid: DataFrame, registry_df: DataFrame,
                  groups: DataFrame, registry: Registry = DEFAULT_REGISTRY,
                  bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                  known: DataFrame | None = None, values: DataFrame | None = None) -> DataFrame:
    """Every reply item of every routed query (``qgroups``: requested group
    rows): device values (J6) and one error item per existing group that has
    no known requested device.  ``delivered_valid`` needs the readings of the
    asked devices only (``asked_readings``).  ``known`` (J4) and ``values`` (J6) of these
    queries are computed here unless the caller has them."""
    if known is None:
        known = query_known_devices(devices_of_groups(qgroups), registry_df)
    if values is None:
        values = query_latest_values(known, delivered_valid, registry, bucket_seconds)
    item_cols = [*QUERY_KEY, "ts", "group_pos", "group", "device_pos", "device"]
    dev_items = values.select(*item_cols, F.lit("data").alias("kind"), "reading_offset", "json")
    qg = qgroups.where("group IS NOT NULL")
    existing = _existing(qg, groups, "left_semi")
    with_known = known.select(*QUERY_KEY, "group_pos").distinct()
    empty = existing.join(with_known, [*QUERY_KEY, "group_pos"], "left_anti")
    err_items = empty.select(*QUERY_KEY, "ts", "group_pos", "group",
                             F.lit(None).cast("long").alias("device_pos"), F.lit(None).cast("string").alias("device"),
                             F.lit("error").alias("kind"), F.lit(None).cast("long").alias("reading_offset"),
                             F.to_json(F.struct(F.concat(F.lit(K.NO_DEVICES_FOUND), F.col("group")).alias("error")))
                             .alias("json"))
    return dev_items.unionByName(err_items)


def gather_with(items: DataFrame, keys: list[str], order: list[str], item: Column,
                fold: Callable[[Column], Column], name: str = "gathered") -> DataFrame:
    """Gather items per key in ``order`` and apply a user fold that needs it (a
    Column function over the ordered array, e.g. via ``F.aggregate``).  A key's
    items come together: for bounded keys, as the items of one document; other
    folds go through ``gather_fold``."""
    arr = F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], item.alias("_item")))),
                      lambda s: s["_item"])
    return items.groupBy(*keys).agg(fold(arr).alias(name))


@dataclass(frozen=True)
class Fold:
    """A user fold that does not need the items' order: ``parts`` are aggregates, each
    of which Spark merges from partial ones; ``finish`` makes the result of their
    values (default: a struct of them)."""

    parts: dict[str, Column]
    finish: Callable[[dict[str, Column]], Column] = lambda p: F.struct(*[c.alias(n) for n, c in p.items()])


def gather_fold(items: DataFrame, keys: list[str], fold: Fold, name: str = "gathered") -> DataFrame:
    """X3 with a mergeable fold: items are folded where they are, and one partial
    result per key and task is shuffled, however many items a key has."""
    g = items.groupBy(*keys).agg(*[c.alias(f"_fold_{n}") for n, c in fold.parts.items()])
    return g.select(*keys, fold.finish({n: F.col(f"_fold_{n}") for n in fold.parts}).alias(name))


def query_keys(qgroups: DataFrame, *more: str) -> DataFrame:
    """One row per good routed building query: its first group row (or the
    single NULL row of a query without groups); no shuffle."""
    return qgroups.where("group_pos = 0 OR group_pos IS NULL").select(*QUERY_KEY, *more)


def gather_query_results(replies: DataFrame, qgroups: DataFrame) -> DataFrame:
    """A4: per query, the ordered list of reply items (group_pos, device_pos).

    A query whose groups all are unknown still answers, with an empty list
    (the gather ends on its idle timeout)."""
    g = gather_with(replies, QUERY_KEY, ["group_pos", "device_pos"],
                    F.struct("group", "device", "kind", "reading_offset", "json"), lambda a: a, "results")
    return (query_keys(qgroups).join(g, QUERY_KEY, "left")
            .withColumn("results", F.coalesce("results", F.array().cast(g.schema["results"].dataType))))


def gather_completeness(qgroups: DataFrame, groups: DataFrame) -> DataFrame:
    """A5: expected replies = requested groups, received = groups that exist;
    complete only when equal and at least one reply was expected (unknown
    groups never answer, so such a gather ends on the timeout)."""
    ex = _existing(qgroups, groups.withColumn("_exists", F.lit(1)), "left")
    agg = (ex.groupBy(*QUERY_KEY)
           .agg(F.count("group").alias("expected_groups"),
                F.count("_exists").alias("received_groups")))
    return agg.withColumn("complete", (F.col("expected_groups") == F.col("received_groups"))
                          & (F.col("expected_groups") > 0))


def query_results_json(results: DataFrame) -> DataFrame:
    """The Query-results-{building} message as valid JSON (buildingId, queryId, results)."""
    body = F.struct(F.col("building").alias("buildingId"), F.col("query_id").alias("queryId"),
                    F.transform("results", lambda r: F.parse_json(r["json"])).alias("results"))
    return results.select(*QUERY_KEY, F.concat(F.lit(K.QUERY_RESULTS_PREFIX + "-"), F.col("building")).alias("out_topic"),
                          F.to_json(body).alias("value"))
