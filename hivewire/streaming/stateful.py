"""Custom stateful stream operators (T2, T5, T8) on ``transformWithStateInPandas``.

State is one small value per key (registry flag, gather progress, device
state), kept in the RocksDB state store and checkpointed with the query.
Within a micro-batch a key's rows are folded in (ts, id) order; across
batches arrival order rules, as in the message log.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import constants as K
from ..operators.devices import DEFAULT_REGISTRY, Registry
from ..operators.registry import DEVICE_KEY

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _use_rocksdb(df: DataFrame) -> None:
    """RocksDB state store for these queries; the package is shipped to the
    Python workers that run the processors."""
    from ..session import ship_package
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    ship_package(df.sparkSession)


def _rows(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """The key's rows of this micro-batch (bounded by the trigger size), in fold order."""
    parts = list(rows)
    if not parts:
        return pd.DataFrame()
    df = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    if len(df) > 1:
        df = df.sort_values(order, kind="stable")
    return df.reset_index(drop=True)


# --- T2: registration replies ---------------------------------------------------

class RegistrationFold(StatefulProcessor):
    """First valid request of a (building, group, device) registers it; later
    ones are 'already running'; invalid ones before it cannot create it."""

    def __init__(self, known_types: list[str]):
        self.known = set(known_types)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reg = handle.getValueState("registered", "reg_event_id LONG")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, ["ts", "event_id"])
        if df.empty:
            return
        registered = self.reg.exists()
        status = []
        first = None
        for dev_type, eid in zip(df["dev_type"], df["event_id"]):
            if registered:
                status.append(K.ALREADY_RUNNING)
            elif dev_type in self.known:
                status.append(K.REGISTERED)
                registered, first = True, int(eid)
            else:
                status.append(K.COULD_NOT_CREATE + K.INVALID_DEVICE_NAME)
        if first is not None:
            self.reg.update((first,))
        yield pd.DataFrame({
            "event_id": df["event_id"].astype("int64"), "building": df["building"], "group_id": df["group_id"],
            "dev_id": df["dev_id"], "reply_topic": "/" + df["building"] + K.REGISTER_SUFFIX + "/" + df["dev_id"],
            "status": status})

    def close(self) -> None:
        pass


def registration_replies(decoded: DataFrame, registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    _use_rocksdb(decoded)
    return (decoded.groupBy(*DEVICE_KEY).transformWithStateInPandas(
        RegistrationFold(registry.names),
        "event_id LONG, building STRING, group_id STRING, dev_id STRING, reply_topic STRING, status STRING",
        "append", "None"))


# --- T5: idle-timeout gather -------------------------------------------------------

class IdleGather(StatefulProcessor):
    """Per user: the first 'purchase' opens a gather; later 'view' replies are
    accepted while the gap since the request / previous reply stays within the
    timeout, until ``expected`` arrived.  An event-time timer closes a silent
    gather; replies after closing are dropped (the done marker stays)."""

    def __init__(self, expected: int, timeout_s: float):
        self.expected, self.timeout_us = expected, int(timeout_s * 1_000_000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.g = handle.getValueState("gather", "request_us LONG, last_us LONG, accepted LONG, done BOOLEAN")

    def _timer(self, last_us: int) -> int:
        return (last_us + self.timeout_us) // 1000 + 1

    def _out(self, key, st) -> pd.DataFrame:
        return pd.DataFrame({"user_id": [int(key[0])], "request_ts": [pd.Timestamp(st[0], unit="us")],
                             "accepted": [int(st[2])], "complete": [st[2] >= self.expected]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, ["ts", "event_id"])
        if df.empty:
            return
        st = list(self.g.get()) if self.g.exists() else None
        if st is not None and st[3]:
            return
        for ts, kind in zip(df["ts"], df["event_type"]):
            t_us = int(pd.Timestamp(ts).value // 1_000)
            if kind == "purchase":
                if st is None:
                    st = [t_us, t_us, 0, False]
                    self.handle.registerTimer(self._timer(t_us))
                continue
            if kind != "view" or st is None or st[3] or t_us <= st[0]:
                continue
            self.handle.deleteTimer(self._timer(st[1]))
            if t_us - st[1] > self.timeout_us:
                st[3] = True
            else:
                st[2] += 1
                st[1] = t_us = max(st[1], t_us)     # a late row does not turn the clock back
                if st[2] >= self.expected:
                    st[3] = True
                else:
                    self.handle.registerTimer(self._timer(t_us))
        if st is not None:
            self.g.update(tuple(st))
            if st[3]:
                yield self._out(key, st)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.g.exists():
            st = list(self.g.get())
            if not st[3]:
                st[3] = True
                self.g.update(tuple(st))
                yield self._out(key, st)

    def close(self) -> None:
        pass


LATENESS_SECONDS = 3600


def idle_gather(events: DataFrame, expected: int, timeout_s: float, lateness: int = LATENESS_SECONDS) -> DataFrame:
    """``events``: user_id, event_id, ts, event_type ('purchase' opens, 'view' replies;
    any other row only moves the time).  One row per gather, when it closes.
    Rows up to ``lateness`` seconds older than the newest row of an earlier
    micro-batch are still taken; timers wait as long."""
    _use_rocksdb(events)
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", f"{lateness} seconds")
    return (e.groupBy("user_id").transformWithStateInPandas(
        IdleGather(expected, timeout_s), "user_id LONG, request_ts TIMESTAMP_NTZ, accepted LONG, complete BOOLEAN",
        "append", "EventTime"))


# --- T8: device state ----------------------------------------------------------------

class DeviceStateFold(StatefulProcessor):
    """Readings and executed commands -> expected state after every event
    (thermostat: the event's value; battery: percentage and the hysteresis
    status with command overrides, 'off' absorbing until the next command)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.s = handle.getValueState("battery", "pct DOUBLE, status STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _rows(rows, ["ts", "kind", "seq"])
        if df.empty:
            return
        pct, status = self.s.get() if self.s.exists() else (K.BATTERY_INITIAL_PERCENTAGE, K.BATTERY_INITIAL_STATUS)
        ev, ep, es = [], [], []
        battery = False
        for dev_type, kind, value, p, set_value, new_status in zip(
                df["dev_type"], df["kind"], df["value"], df["percentage"], df["set_value"], df["new_status"]):
            if dev_type == K.THERMOSTAT:
                v = set_value if kind == 1 else value
                ev.append(None if pd.isna(v) else float(v))
                ep.append(None)
                es.append(None)
                continue
            battery = True
            if kind == 1:
                status = new_status
            else:
                if status != K.OFF:
                    if pct <= K.BATTERY_LOW:
                        status = K.CHARGING
                    elif pct >= K.BATTERY_HIGH:
                        status = K.DISCHARGING
                pct = float(p)
            ev.append(None)
            ep.append(pct)
            es.append(status)
        if battery:
            self.s.update((pct, status))
        yield pd.DataFrame({
            "building": df["building"], "group_id": df["group_id"], "dev_id": df["dev_id"],
            "dev_type": df["dev_type"], "ts": df["ts"],
            "kind": ["reading" if k == 0 else "command" for k in df["kind"]],
            "seq": df["seq"].astype("int64"),
            "expected_value": pd.Series(ev, dtype="float64"), "expected_percentage": pd.Series(ep, dtype="float64"),
            "expected_status": pd.Series(es, dtype="object")})

    def close(self) -> None:
        pass


def device_state(events: DataFrame) -> DataFrame:
    _use_rocksdb(events)
    return (events.groupBy(*DEVICE_KEY).transformWithStateInPandas(
        DeviceStateFold(),
        "building STRING, group_id STRING, dev_id STRING, dev_type STRING, ts TIMESTAMP_NTZ, kind STRING, "
        "seq LONG, expected_value DOUBLE, expected_percentage DOUBLE, expected_status STRING",
        "append", "None"))
