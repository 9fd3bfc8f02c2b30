"""Small builders for literal test inputs."""

from __future__ import annotations

import datetime as dt
import json

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def requests_df(spark, rows):
    """rows: (event_id, second, building, payload dict or raw text)."""
    data = [(eid, at(sec), b, f"/{b}/register", p if isinstance(p, str) else json.dumps(p)) for eid, sec, b, p in rows]
    return spark.createDataFrame(data, "event_id LONG, ts TIMESTAMP_NTZ, building STRING, topic STRING, payload STRING")


def log_df(spark, rows):
    """rows: (msg_offset, second, topic, payload dict or raw text)."""
    data = [(o, at(sec), t, p if isinstance(p, str) else json.dumps(p)) for o, sec, t, p in rows]
    return spark.createDataFrame(data, "msg_offset LONG, ts TIMESTAMP_NTZ, topic STRING, payload STRING")


def docs_df(spark, rows):
    """rows: (event_id, second, payload dict or raw text)."""
    data = [(e, at(sec), p if isinstance(p, str) else json.dumps(p)) for e, sec, p in rows]
    return spark.createDataFrame(data, "event_id LONG, ts TIMESTAMP_NTZ, payload STRING")


def buildings_df(spark, names, region="R1"):
    return spark.createDataFrame([(n, region) for n in names], "building STRING, region STRING")


def register(building, group, dev, dev_type, path=None):
    return {"groupId": group, "devId": dev, "devType": dev_type,
            "modulePath": path or f"/{building}/{group}/t/{dev}"}
