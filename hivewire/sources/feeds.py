"""Message feeds derived from the driver tables.

Every feed is one SELECT over a driver table.  The same expression text builds
the Spark DataFrame (``selectExpr``/``where``: Catalyst pushes the filter and
the column list into the parquet scan) and the SQL that the DuckDB oracle runs,
so both engines start from identical rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .tables import read_table


@dataclass(frozen=True)
class Feed:
    name: str
    table: str
    where: str
    select: tuple[str, ...]

    def sql(self) -> str:
        return f"SELECT {', '.join(self.select)} FROM {self.table} WHERE {self.where}"

    def load(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return read_table(spark, sf_dir, self.table).where(self.where).selectExpr(*self.select)


# Registration requests: building from the topic, the payload carries the rest;
# event_id % 11 = 0 lacks devType (quarantine), devType cycles over two known
# types and one unknown ('toaster').
REGISTER_REQUESTS = Feed(
    "register_requests", "events", "event_type = 'signup'",
    (
        "event_id", "ts",
        "concat('building', user_id % 25) AS building",
        "concat('/building', user_id % 25, '/register') AS topic",
        "concat('{\"groupId\":\"module', event_id % 2, '\",\"devId\":\"d', user_id, "
        "CASE WHEN event_id % 11 = 0 THEN '' ELSE concat('\",\"devType\":\"', "
        "CASE event_id % 3 WHEN 0 THEN 'thermostat' WHEN 1 THEN 'battery' ELSE 'toaster' END) END, "
        "'\",\"modulePath\":\"/building', user_id % 25, '/module', event_id % 2, '/telemetry/d', user_id, '\"}') AS payload",
    ),
)

# Readings: one payload serves both device types (decoders ignore extra
# fields); 'error' events give three kinds of broken payloads.
TELEMETRY_RAW = Feed(
    "telemetry_raw", "events", "event_type IN ('view', 'click', 'error')",
    (
        "event_id AS msg_offset", "ts",
        "concat('/building', user_id % 25, '/module', event_id % 2, '/telemetry/d', user_id) AS topic",
        "CASE "
        "WHEN event_type = 'error' AND event_id % 4 = 0 THEN '{\"deviceId\":' "
        "WHEN event_type = 'error' AND event_id % 4 = 1 THEN concat('{\"deviceId\":\"d', user_id, '\",\"timestamp\":\"t\"}') "
        "WHEN event_type = 'error' AND event_id % 4 = 2 THEN concat('{\"deviceId\":', user_id, "
        "',\"value\":1.5,\"unit\":\"Celsius\",\"percentage\":50.5,\"status\":\"off\",\"timestamp\":\"t\"}') "
        "ELSE concat('{\"deviceId\":\"d', user_id, '\",\"value\":', value, ',\"unit\":\"Celsius\",\"percentage\":', value, "
        "',\"status\":\"', CASE event_id % 5 WHEN 0 THEN 'charging' WHEN 1 THEN 'discharging' WHEN 2 THEN 'off' "
        "WHEN 3 THEN 'discharging' ELSE 'idle' END, '\",\"timestamp\":\"', substr(CAST(ts AS STRING), 1, 19), '\"}') "
        "END AS payload",
    ),
)

# Readings with one more member, for a plugged-in type; broken payloads stay as they are.
POWERED_TELEMETRY = (
    "msg_offset", "ts", "topic",
    "CASE WHEN payload LIKE '%}' THEN concat(substr(payload, 1, length(payload) - 1), ',\"power\":', msg_offset % 100, '}') "
    "ELSE payload END AS payload",
)

# Region query envelopes: % 3 adds an unknown group, % 7 repeats the building
# (last wins), % 10 = 8 lacks groupList (whole document to quarantine).
QUERIES_RAW = Feed(
    "queries_raw", "events", "event_type = 'purchase' AND event_id % 2 = 0",
    (
        "event_id", "ts",
        "CASE WHEN event_id % 10 = 8 THEN concat('{\"buildings\":[{\"building\":\"building', user_id % 25, '\"}]}') "
        "ELSE concat('{\"buildings\":[{\"building\":\"building', user_id % 25, '\",\"groupList\":{\"queryId\":\"q', event_id, "
        "'\",\"groups\":[{\"group\":\"module', user_id % 2, '\",\"devices\":[\"d', user_id, '\",\"d', user_id, '\",\"d', user_id + 25, "
        "'\",\"error_id\"]}', CASE WHEN event_id % 3 = 0 THEN ',{\"group\":\"error_group\",\"devices\":[]}' ELSE '' END, ']}}', "
        "CASE WHEN event_id % 7 = 0 THEN concat(',{\"building\":\"building', user_id % 25, '\",\"groupList\":{\"queryId\":\"r', event_id, "
        "'\",\"groups\":[{\"group\":\"module', user_id % 2, '\",\"devices\":[\"d', user_id, '\"]}]}}') ELSE '' END, ']}') END AS payload",
    ),
)

# Region command envelopes: an unknown group, one command for a real device
# ('set' number or 'change-status' text), one for an unknown device.
COMMANDS_RAW = Feed(
    "commands_raw", "events", "event_type = 'purchase' AND event_id % 2 = 1",
    (
        "event_id", "ts",
        "concat('{\"buildings\":[{\"building\":\"building', user_id % 25, "
        "'\",\"cmdList\":{\"commands\":[{\"groupId\":\"error_group\",\"devices\":[]},{\"groupId\":\"module', "
        "user_id % 2, '\",\"devices\":[{\"deviceId\":\"d', user_id, '\",\"command\":', "
        "CASE event_id % 4 WHEN 1 THEN concat('{\"name\":\"set\",\"value\":', value, '}') "
        "ELSE concat('{\"name\":\"change-status\",\"value\":\"', CASE event_id % 3 WHEN 0 THEN 'charging' "
        "WHEN 1 THEN 'off' ELSE 'idle' END, '\"}') END, "
        "'},{\"deviceId\":\"error_id\",\"command\":{}}]}]}}]}') AS payload",
    ),
)

# Device inventory documents (edge start-up lists), one per signup event: two
# devices, the second of a type chosen by event_id % 3
# (one unknown type), sending period from the event value.
DEVICE_LISTS = Feed(
    "device_lists", "events", "event_type = 'signup'",
    (
        "event_id", "ts",
        "concat('{\"buildingId\":\"building', user_id % 25, '\",\"devices\":[', "
        "'{\"deviceType\":\"thermostat\",\"deviceId\":\"t', user_id, '\",\"module\":\"module', event_id % 2, "
        "'\",\"publishingTopic\":\"temperature\",\"dataSendingPeriod\":', value, '},', "
        "'{\"deviceType\":\"', CASE event_id % 3 WHEN 0 THEN 'battery' WHEN 1 THEN 'thermostat' ELSE 'toaster' END, "
        "'\",\"deviceId\":\"b', user_id, '\",\"module\":\"module', (event_id + 1) % 2, "
        "'\",\"publishingTopic\":\"status\",\"dataSendingPeriod\":', user_id % 7, '}]}') AS payload",
    ),
)

# Building registration requests to a region manager (U2): every purchase
# event asks to register building{user_id % 30} in region (user_id % 5); ids 25..29 are new buildings.
BUILDING_REQUESTS = Feed(
    "building_requests", "events", "event_type = 'purchase'",
    (
        "event_id", "ts",
        "concat('building', user_id % 30) AS building",
        "CAST(user_id % 5 AS INT) AS r_regionkey",
    ),
)

# Replies of asked devices, one after the other: a tenth of the purchase's value in seconds each, so that
# some come in time, some after their group's or building's timer.
REPLY_DELAYS = Feed(
    "reply_delays", "events", "event_type = 'purchase'",
    ("event_id", "CAST(round(value * 100) AS BIGINT) AS delay_ms"),
)

# Registration requests as the devices send them (the sender knows its own name, whatever the payload), and
# how long the reply takes: a tenth of the event's value in seconds; unreadable requests get none.
EDGE_REQUESTS = Feed(
    "edge_requests", "events", "event_type = 'signup'",
    ("event_id", "ts", "concat('building', user_id % 25) AS building", "concat('d', user_id) AS dev_id",
     "CAST(round(value * 100) AS BIGINT) AS delay_ms"),
)
REGISTER_TIMEOUT_SECONDS = 5

# Region of every building; documents also name buildings that are not
# registered (nations 20..24), so the registered ones are nations 0..19.
ALL_BUILDINGS_SQL = (
    "SELECT concat('building', n_nationkey) AS building, r_name AS region "
    "FROM nation JOIN region ON n_regionkey = r_regionkey"
)
BUILDINGS_SQL = ALL_BUILDINGS_SQL + " WHERE n_nationkey < 20"


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_buildings(spark, sf_dir, "n_nationkey < 20")


def all_buildings(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").where(where)
    region = read_table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .selectExpr("concat('building', n_nationkey) AS building", "r_name AS region"))


def building_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    req = BUILDING_REQUESTS.load(spark, sf_dir)
    region = read_table(spark, sf_dir, "region")
    return req.join(region, "r_regionkey").selectExpr("event_id", "ts", "building", "r_name AS region")


BUILDING_REQUESTS_SQL = (
    "SELECT event_id, ts, building, r_name AS region FROM ("
    + BUILDING_REQUESTS.sql() + ") b JOIN region USING (r_regionkey)"
)

# Buildings as a stream learns them: the registered ones from the start, others
# since their first request.
LIVE_BUILDINGS_SQL = (
    "SELECT building, min(since) AS since FROM (SELECT building, TIMESTAMP '0001-01-01' AS since FROM (" + BUILDINGS_SQL
    + ") UNION ALL SELECT building, ts FROM (" + BUILDING_REQUESTS_SQL + ")) GROUP BY building"
)

# Request/reply feed of the idle-timeout gatherer (W4/T5): the request is the
# first purchase of each user, replies are that user's later 'view' events.
GATHER_EXPECTED = 5
GATHER_TIMEOUT_HOURS = 72


def gather_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return (ev.groupBy("user_id")
            .agg({"ts": "min"}).withColumnRenamed("min(ts)", "request_ts"))


def gather_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").where("event_type = 'view'")
    return ev.select("user_id", "event_id", "ts")


GATHER_REQUESTS_SQL = "SELECT user_id, min(ts) AS request_ts FROM events WHERE event_type = 'purchase' GROUP BY user_id"
GATHER_REPLIES_SQL = "SELECT user_id, event_id, ts FROM events WHERE event_type = 'view'"

FEEDS = {f.name: f for f in (REGISTER_REQUESTS, TELEMETRY_RAW, QUERIES_RAW, COMMANDS_RAW, DEVICE_LISTS, REPLY_DELAYS, EDGE_REQUESTS)}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FEEDS[name].load(spark, sf_dir)
