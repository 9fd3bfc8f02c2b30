"""Registered queries: one per operator of the inventory, each a function
(spark, sf_dir) -> DataFrame over the driver tables.  Output columns are
plain comparable values (lists are joined to text in position order) so the
SQL oracle can be checked value by value.
"""

from __future__ import annotations

from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import json as J
from ..operators import command as C
from ..operators import decode as D
from ..operators import envelopes as E
from ..operators import latest as L
from ..operators import nested as N
from ..operators import query as Q
from ..operators import registry as R
from ..operators import state as S
from ..operators.devices import BATTERY, THERMOSTAT, Command, DeviceType, Field, Registry
from ..operators.fold import STATE, Lift, StateRule, is_kind, merged
from ..operators.registry import DEVICE_KEY
from ..session import scratch_path
from ..sources import feeds
from ..sources import topic_log as TL


class Ctx:
    """Feeds and shared intermediate plans of one (session, data folder).

    An intermediate used by several branches or queries (decoded requests,
    registry, groups, routed documents, requested groups, decoded readings)
    is built once and persisted (memory, spilling to disk; lost blocks are
    rebuilt from lineage), so a raw log is scanned and parsed once instead of
    once per branch."""

    def __init__(self, spark: SparkSession, sf_dir: str, registry: Registry | None = None):
        self.spark, self.sf = spark, sf_dir
        self.types = registry or Registry()
        self._memo: dict[str, DataFrame] = {}

    def _keep(self, key: str, build) -> DataFrame:
        if key not in self._memo:
            # Persisted plans are also found again by Spark's cache manager when
            # another query builds the same plan, so a log is decoded once per
            # session, not once per query.
            self._memo[key] = build().persist(StorageLevel.MEMORY_AND_DISK)
        return self._memo[key]

    def release(self, *keys: str) -> None:
        """Let go of kept intermediates that nothing reads any more."""
        for k in keys:
            if k in self._memo:
                self._memo.pop(k).unpersist()

    def feed(self, name: str) -> DataFrame:
        return feeds.load(self.spark, self.sf, name)

    @property
    def requests(self): return self.feed("register_requests")
    @property
    def telemetry(self): return self.feed("telemetry_raw")
    @property
    def queries_raw(self): return self.feed("queries_raw")
    @property
    def commands_raw(self): return self.feed("commands_raw")
    @property
    def buildings(self): return self._keep("buildings", lambda: feeds.buildings(self.spark, self.sf))
    @property
    def building_requests(self): return feeds.building_requests(self.spark, self.sf)
    @property
    def live_buildings(self): return R.building_instants(self.buildings, self.building_requests)
    @property
    def decoded_requests(self): return self._keep("decoded_requests", lambda: R.decoded_requests(self.requests))
    @property
    def registry(self): return self._keep("registry", lambda: R.registry_of(self.decoded_requests, self.types))
    @property
    def groups(self): return self._keep("groups", lambda: R.groups_of(self.decoded_requests))
    @property
    def routed_queries(self): return self._keep("routed_queries", lambda: Q.routed_queries(self.queries_raw, self.buildings))
    @property
    def query_groups(self): return self._keep("query_groups", lambda: E.explode_query_groups(self.routed_queries))
    @property
    def routed_commands(self): return self._keep("routed_commands", lambda: C.routed_commands(self.commands_raw, self.buildings))
    @property
    def known_devices(self):
        return self._keep("known_devices", lambda: Q.query_known_devices(E.devices_of_groups(self.query_groups), self.registry))
    @property
    def asked_readings(self):
        """Kept with what replies are made of: the carry of J6 reads them twice."""
        cols = [*DEVICE_KEY, "dev_type", "msg_offset", "ts", *D.reading_columns(self.types)]
        return self._keep("asked_readings", lambda: Q.asked_readings(
            self.telemetry, self.known_devices, self.registry, self.types, self._memo.get("decoded_readings")).select(*cols))
    @property
    def latest_values(self):
        return self._keep("latest_values", lambda: Q.query_latest_values(self.known_devices, self.asked_readings, self.types))
    @property
    def replies(self):
        return Q.query_replies(self.query_groups, self.asked_readings, self.registry, self.groups, self.types, known=self.known_devices)
    @property
    def decoded_readings(self):
        return self._keep("decoded_readings", lambda: L.decoded_readings(self.telemetry, self.registry, self.types))


def _cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


# --- sources / sinks -------------------------------------------------------

def read_topic_log(c: Ctx) -> DataFrame:
    """The telemetry feed written as a message log and scanned back."""
    path = scratch_path(c.spark, "topic-log")
    TL.write_topic_log(c.telemetry.select("topic", "msg_offset", "ts", "payload"), path)
    return _cols(TL.read_topic_log(c.spark, path, schema=TL.LOG_SCHEMA), "msg_offset", "ts", "topic", "payload")


def subscribe_topics(c: Ctx) -> DataFrame:
    topics = c.buildings.select(F.concat(F.lit("/"), "building", F.lit(K.REGISTER_SUFFIX)).alias("topic"))
    return _cols(L.subscribe_topics(c.requests, topics), "event_id", "ts", "topic")


def to_topics(routed: DataFrame, prefix: str) -> DataFrame:
    """S3 rows: each routed body as JSON on ``{prefix}-{building}``."""
    return routed.select("event_id", "pos", "building", F.concat(F.lit(prefix + "-"), "building").alias("out_topic"),
                         F.to_json("body").alias("value"))


def bodies_of(written: DataFrame) -> DataFrame:
    """What the routed messages say: a query's id, a command list's number of groups."""
    v = J.parse(F.col("value"))
    return written.select("event_id", "pos", "building", "out_topic",
                          J.get_string(J.field(v, "queryId")).alias("query_id"),
                          F.size(J.as_array(J.field(v, "commands"))).cast("long").alias("n_groups"))


def route_to_topics(c: Ctx) -> DataFrame:
    """S3: routed query and command bodies written under their topics and read back."""
    path = scratch_path(c.spark, "routed")
    both = to_topics(c.routed_queries, K.QUERY_PREFIX).unionByName(to_topics(c.routed_commands, K.COMMAND_PREFIX))
    TL.write_routed(both, path)
    return bodies_of(c.spark.read.schema(both.schema).parquet(path))


def load_device_inventory(c: Ctx) -> DataFrame:
    inv = TL.load_device_inventory(c.feed("device_lists"), registry=c.types)
    return _cols(inv, "event_id", "building", "device_pos", "device_type", "device_id", "module",
                 "publishing_topic", "period_s", "topic", "error")


def retained_snapshot(c: Ctx) -> DataFrame:
    return L.retained_snapshot(c.telemetry)


def first_message_per_topic(c: Ctx) -> DataFrame:
    return L.first_message_per_topic(c.telemetry)


# --- decode / validate / encode ---------------------------------------------

def decode_thermostat(c: Ctx) -> DataFrame:
    return _cols(D.decode_thermostat(c.telemetry), "msg_offset", "topic", "deviceId", "value", "unit",
                 "timestamp", "event_ts", "reason")


def decode_battery(c: Ctx) -> DataFrame:
    return _cols(D.decode_battery(c.telemetry), "msg_offset", "topic", "deviceId", "percentage", "status",
                 "timestamp", "reason")


def quarantine_telemetry(c: Ctx) -> DataFrame:
    _, bad = D.split(L.delivered_readings(c.telemetry, c.registry, c.types))
    return _cols(bad, "msg_offset", "topic", "building", "group_id", "dev_id", "dev_type", "reason")


def encode_telemetry(c: Ctx) -> DataFrame:
    return _cols(L.encode_telemetry(c.telemetry, c.registry, c.types), "msg_offset", "building", "group_id", "dev_id",
                 "out_topic", "json")


def decode_register(c: Ctx) -> DataFrame:
    return _cols(D.decode_register(c.requests), "event_id", "building", "group_id", "dev_id", "dev_type",
                 "module_path", "reason")


def filter_known_types(c: Ctx) -> DataFrame:
    return _cols(D.filter_known_types(c.decoded_requests, c.types), "event_id", "building", "dev_id", "dev_type",
                 "accepted", "error")


def build_topic_paths(c: Ctx) -> DataFrame:
    return R.build_topic_paths(c.registry).drop("dev_type")


def explode_query_envelope(c: Ctx) -> DataFrame:
    e = E.explode_envelope(c.queries_raw, E.QUERY_BODY)
    return e.select("event_id", "pos", "building", J.get_string(J.field(F.col("body"), "queryId")).alias("query_id"))


def envelope_last_wins(c: Ctx) -> DataFrame:
    e = E.explode_envelope(c.queries_raw, E.QUERY_BODY, last_wins=True)
    return e.select("event_id", "pos", "building", J.get_string(J.field(F.col("body"), "queryId")).alias("query_id"))


def route_to_registered_buildings(c: Ctx) -> DataFrame:
    return _cols(c.routed_queries, "event_id", "pos", "building")


def explode_query_devices(c: Ctx) -> DataFrame:
    return _cols(E.devices_of_groups(c.query_groups), "event_id", "building", "query_id",
                 "group_pos", "group", "device_pos", "device")


def explode_command_envelope(c: Ctx) -> DataFrame:
    e = E.explode_envelope(c.commands_raw, E.COMMAND_BODY)
    return e.select("event_id", "pos", "building",
                    F.size(J.as_array(J.field(F.col("body"), "commands"))).cast("long").alias("n_groups"))


def explode_commands(c: Ctx) -> DataFrame:
    x = E.explode_commands(c.routed_commands)
    cmd = F.col("command")
    return x.select("event_id", "building", "group_pos", "group_id", "device_pos", "device_id",
                    J.get_string(J.field(cmd, "name")).alias("cmd_name"),
                    J.get_double(J.field(cmd, "value")).alias("cmd_number"),
                    J.get_string(J.field(cmd, "value")).alias("cmd_text"))


def validate_commands(c: Ctx) -> DataFrame:
    v = C.validate_commands(c.routed_commands, c.groups, c.registry, c.types)
    return _cols(v, "event_id", "building", "group_pos", "device_pos", "device_id", "dev_type", "valid",
                 "reason", "set_value", "new_status")


# --- joins ---------------------------------------------------------------------

def telemetry_of_registered(c: Ctx) -> DataFrame:
    return _cols(L.telemetry_of_registered(c.telemetry, c.registry), "msg_offset", "topic", "building",
                 "group_id", "dev_id", "dev_type")


def replay_since_registration(c: Ctx) -> DataFrame:
    return _cols(L.replay_since_registration(c.telemetry, c.registry), "msg_offset", "ts", "topic",
                 "building", "group_id", "dev_id", "retained")


def query_known_devices(c: Ctx) -> DataFrame:
    return _cols(c.known_devices, "event_id", "building", "query_id", "group_pos", "group", "device_pos", "device", "dev_type")


def query_unknown_groups(c: Ctx) -> DataFrame:
    u = Q.query_unknown_groups(c.query_groups, c.groups)
    return _cols(u, "event_id", "building", "query_id", "group_pos", "group")


def query_latest_values(c: Ctx) -> DataFrame:
    v = Q.query_latest_values(c.known_devices, c.asked_readings, c.types)
    return v.select("event_id", "building", "query_id", "group_pos", "device_pos", "device", "dev_type",
                    "reading_offset", F.col("reading_offset").isNotNull().alias("has_data"),
                    "value", "percentage", "status")


def command_dispatch_status(c: Ctx) -> DataFrame:
    s = C.command_dispatch_status(c.routed_commands, c.groups, c.registry, c.types)
    return _cols(s, "event_id", "building", "group_pos", "group_id", "device_pos", "device_id", "ok",
                 "message", "cmd_topic")


# --- aggregations ------------------------------------------------------------

def device_registry(c: Ctx) -> DataFrame:
    return c.registry


def list_groups(c: Ctx) -> DataFrame:
    return c.groups


def latest_per_device(c: Ctx) -> DataFrame:
    return _cols(L.latest_per_device(c.telemetry, c.registry, c.types), "building", "group_id", "dev_id",
                 "dev_type", "msg_offset", "ts", "value", "unit", "percentage", "status")


def _item_text():
    return F.concat_ws(":", "kind", "group", F.coalesce("device", F.lit("")),
                       F.coalesce(F.col("reading_offset").cast("string"), F.lit("-")))


def gather_query_results(c: Ctx) -> DataFrame:
    return results_text(c.replies, c.query_groups)


def results_text(rep: DataFrame, query_groups: DataFrame) -> DataFrame:
    """A4 as text: the number of reply items of a query and the items in order."""
    g = Q.gather_with(rep, Q.QUERY_KEY, ["group_pos", "device_pos"], _item_text(),
                      lambda a: F.struct(F.size(a).cast("long").alias("n_items"), F.array_join(a, ";").alias("items")),
                      "r")
    g = g.select(*Q.QUERY_KEY, "r.n_items", "r.items")
    return (Q.query_keys(query_groups).join(g, Q.QUERY_KEY, "left")
            .select(*Q.QUERY_KEY, F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                    F.coalesce("items", F.lit("")).alias("items")))


def gather_completeness(c: Ctx) -> DataFrame:
    return Q.gather_completeness(c.query_groups, c.groups)


def gather_command_status(c: Ctx) -> DataFrame:
    return C.gather_command_status(C.command_rows(c.routed_commands, c.groups, c.registry, c.types))


def list_buildings(c: Ctx) -> DataFrame:
    return R.list_buildings(feeds.all_buildings(c.spark, c.sf))


# --- ordered computations ----------------------------------------------------

def registration_status(c: Ctx) -> DataFrame:
    return _cols(R.statuses_of(c.decoded_requests, c.types, c.registry), "event_id", "building", "group_id", "dev_id",
                 "reply_topic", "status")


def battery_expected_status(c: Ctx) -> DataFrame:
    return S.battery_expected_status(c.telemetry, c.registry).drop("ts")


def reconcile_commands(c: Ctx) -> DataFrame:
    return C.reconcile_commands(c.telemetry, c.routed_commands, c.groups, c.registry, c.types).drop("ts")


def gather_idle_cutoff(c: Ctx) -> DataFrame:
    return S.gather_idle_cutoff(feeds.gather_requests(c.spark, c.sf), feeds.gather_replies(c.spark, c.sf),
                                feeds.GATHER_EXPECTED, feeds.GATHER_TIMEOUT_HOURS * 3600)


def device_lifecycle(c: Ctx) -> DataFrame:
    return R.device_lifecycle(c.requests, c.types)


def _after(ts: str, milliseconds) -> Column:
    return F.timestamp_add("MILLISECOND", milliseconds, F.col(ts))


REPLY_PARTS = ("replying_devices", "replied_readings")


def device_replies(c: Ctx, qgroups: DataFrame) -> DataFrame:
    """The replies of the asked devices (J6), each ``delay_ms`` after the one before.
    What they are made of is kept (``REPLY_PARTS``): several branches read it."""
    known = c._keep("replying_devices", lambda: Q.query_known_devices(E.devices_of_groups(qgroups), c.registry))
    cols = [*DEVICE_KEY, "dev_type", "msg_offset", "ts", *D.reading_columns(c.types)]
    readings = c._keep("replied_readings", lambda: Q.asked_readings(c.telemetry, known, c.registry, c.types).select(*cols))
    values = Q.query_latest_values(known, readings, c.types)
    text = _item_text()
    return (values.withColumn("kind", F.lit("data")).join(c.feed("reply_delays"), "event_id")
            .select(*N.GROUP_KEY, "device_pos", _after("ts", (F.col("device_pos") + 1) * F.col("delay_ms")).alias("ts"), text.alias("text"))
            .where("ts IS NOT NULL"))


def gather_two_level(c: Ctx) -> DataFrame:
    """A4/A5 with the timers of groups and buildings."""
    return N.two_level_gather(N.asked_groups(c.query_groups, c.registry, c.groups), device_replies(c, c.query_groups))


def registration_replies(c: Ctx) -> DataFrame:
    """Replies to registration requests (W1), each ``delay_ms`` after its request."""
    delays = c.feed("edge_requests").select("event_id", "delay_ms")
    return (R.registration_status(c.requests, c.types).join(delays, "event_id")
            .select("event_id", _after("ts", F.col("delay_ms")).alias("ts"), "building", "dev_id", "status").where("ts IS NOT NULL"))


def device_attempts(c: Ctx) -> DataFrame:
    """W5 with retries and deadlines."""
    return N.device_attempts(c.feed("edge_requests").drop("delay_ms"), registration_replies(c), feeds.REGISTER_TIMEOUT_SECONDS)


# --- set operations ----------------------------------------------------------

def union_building_feeds(c: Ctx) -> DataFrame:
    """A region's view: Data-b and Query-results-b of each of its buildings."""
    data = encode_telemetry(c).select("building", "out_topic", F.lit("data").alias("kind"),
                                      F.col("msg_offset").alias("key"))
    res = gather_query_results(c).select("building", F.concat(F.lit(K.QUERY_RESULTS_PREFIX + "-"), "building")
                                         .alias("out_topic"), F.lit("query-results").alias("kind"),
                                         F.col("event_id").alias("key"))
    both = data.unionByName(res)
    return both.join(c.buildings, "building").select("region", "building", "out_topic", "kind", "key")


def merge_building_registry(c: Ctx) -> DataFrame:
    return _cols(R.merge_building_registry(c.buildings, feeds.building_requests(c.spark, c.sf)),
                 "event_id", "region", "building", "ok", "message")


# --- extension surface -------------------------------------------------------

# A third, command-less device type plugged in through the registry (X1):
# 'toaster' readings carry a string deviceId and a number value.
TOASTER = DeviceType("toaster", (Field("deviceId", "string"), Field("value", "number"),
                                 Field("timestamp", "string")))
EXTENDED = Registry((THERMOSTAT, BATTERY, TOASTER))


def device_type_registry(c: Ctx) -> DataFrame:
    e = Ctx(c.spark, c.sf, EXTENDED)
    s = C.command_dispatch_status(e.routed_commands, e.groups, e.registry, e.types)
    return _cols(s.where("device_pos IS NOT NULL"), "event_id", "building", "group_pos", "device_pos",
                 "device_id", "ok", "message")


# The same type name as a full plug-in: a number field of its own (power), a
# command and a state rule whose values merge as last, sum and maximum.
TOASTER_LIMIT = 100.0


def _limit_command(v):
    """'set' with a number from 0 to ``TOASTER_LIMIT``."""
    name, value = J.field(v, "name"), J.field(v, "value")
    shape = J.is_object(v) & J.is_string(name) & (J.get_string(name) == K.SET) & J.is_number(value)
    ok = F.coalesce(shape & J.get_double(value).between(0.0, TOASTER_LIMIT), F.lit(False))
    return ok, F.when(~ok, F.lit("unsupported command")), F.when(ok, J.get_double(value)), F.lit(None).cast("string")


POWERED_TOASTER = DeviceType(
    "toaster", (Field("deviceId", "string"), Field("power", "number"), Field("timestamp", "string")),
    command=Command(_limit_command),
    state=StateRule(
        {"expected_limit": lambda: F.coalesce(merged("toaster", "limit"), F.lit(TOASTER_LIMIT)),
         "expected_used": lambda: F.coalesce(merged("toaster", "used"), F.lit(0.0)),
         "expected_peak": lambda: merged("toaster", "peak")},
        ((Lift("limit", lambda: F.coalesce("set_value", "expected_limit")),
          Lift("used", lambda: F.when(is_kind(STATE), F.col("expected_used")).otherwise(F.col("power")), how="sum"),
          Lift("peak", lambda: F.coalesce("power", "expected_peak"), how="max")),)))
POWERED = Registry((THERMOSTAT, BATTERY, POWERED_TOASTER))


class PoweredCtx(Ctx):
    """Readings that also carry a ``power`` member."""

    @property
    def telemetry(self): return self.feed("telemetry_raw").selectExpr(*feeds.POWERED_TELEMETRY)


def device_type_plugin(c: Ctx) -> DataFrame:
    """A plugged-in type through A3 (``latest``), J6 (``value``), A4 (``result``) and
    W3 (``state``), as rows of one table.  All four read the same decoded readings,
    the results the same values, so a message is parsed once and J6 runs once."""
    e = PoweredCtx(c.spark, c.sf, POWERED)
    ours = F.col("dev_type") == POWERED_TOASTER.name
    none = lambda kind: F.lit(None).cast(kind)       # noqa: E731

    def rows(df, section, key, a, b=none("double"), more=none("double"), text=none("string"), keys=DEVICE_KEY):
        return df.select(F.lit(section).alias("section"), *[F.col(k) if k in keys else none("string").alias(k) for k in DEVICE_KEY],
                         F.col(key).alias("key"), a.cast("double").alias("a"), b.cast("double").alias("b"),
                         more.cast("double").alias("c"), text.alias("text"))

    latest = L.latest_per_device(e.telemetry, e.registry, e.types, e.decoded_readings).where(ours)
    values = e.latest_values.where(ours).withColumnsRenamed(
        {"group": "group_id", "device": "dev_id"})
    place = F.concat_ws(":", "query_id", "group_pos", "device_pos")
    replies = Q.query_replies(e.query_groups, e.asked_readings, e.registry, e.groups, e.types, known=e.known_devices,
                              values=e.latest_values)
    results = Q.gather_query_results(replies, e.query_groups)
    states = C.reconcile_commands(e.telemetry, e.routed_commands, e.groups, e.registry, e.types).where(ours)
    return (rows(latest, "latest", "msg_offset", F.col("power"))
            .unionByName(rows(values, "value", "event_id", F.col("power"), F.col("reading_offset"), text=place))
            .unionByName(rows(results, "result", "event_id", F.size("results"), text=F.col("query_id"), keys=["building"]))
            .unionByName(rows(states, "state", "seq", F.col("expected_limit"), F.col("expected_used"), F.col("expected_peak"),
                              F.col("kind"))))


def _has_device(p):
    """A user parse function for X2: the message must name a device."""
    v = J.parse(p)
    reason = F.when(v.isNull(), F.lit("malformed")).when(~J.is_string(J.field(v, "deviceId")), F.lit("no device"))
    return reason, {"device_id": J.get_string(J.field(v, "deviceId"))}


def parse_with(c: Ctx) -> DataFrame:
    return _cols(D.parse_with(c.telemetry, _has_device), "msg_offset", "device_id", "reason")


def gather_with(c: Ctx) -> DataFrame:
    """Replies of a query counted by a mergeable fold."""
    rep = c.replies
    has = F.col("reading_offset").isNotNull()
    fold = Q.Fold({"d": F.count_if((F.col("kind") == "data") & has), "n": F.count_if((F.col("kind") == "data") & ~has),
                   "e": F.count_if(F.col("kind") == "error")})
    g = Q.gather_fold(rep, Q.QUERY_KEY, fold, "f")
    return g.select(*Q.QUERY_KEY, F.col("f.d").alias("n_with_data"), F.col("f.n").alias("n_no_data"),
                    F.col("f.e").alias("n_errors"))


BATCH: dict[str, Callable[[Ctx], DataFrame]] = {
    "read_topic_log": read_topic_log,
    "subscribe_topics": subscribe_topics,
    "route_to_topics": route_to_topics,
    "load_device_inventory": load_device_inventory,
    "retained_snapshot": retained_snapshot,
    "decode_thermostat": decode_thermostat,
    "decode_battery": decode_battery,
    "quarantine_telemetry": quarantine_telemetry,
    "encode_telemetry": encode_telemetry,
    "decode_register": decode_register,
    "explode_query_envelope": explode_query_envelope,
    "explode_query_devices": explode_query_devices,
    "explode_command_envelope": explode_command_envelope,
    "explode_commands": explode_commands,
    "validate_commands": validate_commands,
    "filter_known_types": filter_known_types,
    "build_topic_paths": build_topic_paths,
    "route_to_registered_buildings": route_to_registered_buildings,
    "telemetry_of_registered": telemetry_of_registered,
    "replay_since_registration": replay_since_registration,
    "query_known_devices": query_known_devices,
    "query_unknown_groups": query_unknown_groups,
    "query_latest_values": query_latest_values,
    "command_dispatch_status": command_dispatch_status,
    "device_registry": device_registry,
    "list_groups": list_groups,
    "latest_per_device": latest_per_device,
    "gather_query_results": gather_query_results,
    "gather_completeness": gather_completeness,
    "gather_command_status": gather_command_status,
    "list_buildings": list_buildings,
    "envelope_last_wins": envelope_last_wins,
    "registration_status": registration_status,
    "battery_expected_status": battery_expected_status,
    "reconcile_commands": reconcile_commands,
    "gather_idle_cutoff": gather_idle_cutoff,
    "device_lifecycle": device_lifecycle,
    "gather_two_level": gather_two_level,
    "device_attempts": device_attempts,
    "first_message_per_topic": first_message_per_topic,
    "union_building_feeds": union_building_feeds,
    "merge_building_registry": merge_building_registry,
    "device_type_registry": device_type_registry,
    "device_type_plugin": device_type_plugin,
    "parse_with": parse_with,
    "gather_with": gather_with,
}


def batch_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, fn=fn: fn(Ctx(spark, sf_dir))) for name, fn in BATCH.items()}
