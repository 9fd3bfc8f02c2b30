"""Keys with most of the rows: the as-of answer (J6) over many small time
buckets, and the idle cut-off (W4) over salted replies, equal brute force."""

import datetime as dt
import random

import pytest

from hivewire.operators import envelopes as E
from hivewire.operators import query as Q
from hivewire.operators import registry as R
from hivewire.operators import state as S
from hivewire.operators.latest import delivered_readings
from tests.helpers import at, buildings_df, docs_df, log_df, register, requests_df

B, PATH = "b1", "/b1/g1/t/hot"


def test_hot_device_as_of_latest(spark):
    rnd = random.Random(7)
    reg_at = 100
    log, readings = [], []
    for i in range(400):
        t = rnd.randint(0, 1000)
        valid = rnd.random() > 0.2
        payload = ({"deviceId": "hot", "value": float(i), "unit": "C", "timestamp": "t"} if valid
                   else {"deviceId": "hot", "value": "bad", "unit": "C", "timestamp": "t"})
        log.append((i, t, PATH, payload))
        readings.append((t, i, valid))
    # a quiet second device on another path
    log.append((1000, 5, "/b1/g1/t/quiet", {"deviceId": "quiet", "value": 1.0, "unit": "C", "timestamp": "t"}))
    reqs = requests_df(spark, [(1, reg_at, B, register(B, "g1", "hot", "thermostat", PATH)),
                               (2, 0, B, register(B, "g1", "quiet", "thermostat", "/b1/g1/t/quiet"))])
    reg, groups = R.device_registry(reqs), R.list_groups(reqs)
    qtimes = [rnd.randint(reg_at, 1000) for _ in range(40)] + [readings[0][0] if readings[0][0] >= reg_at else reg_at]
    docs = docs_df(spark, [(5000 + k, qt, {"buildings": [{"building": B, "groupList": {
        "queryId": f"q{k}", "groups": [{"group": "g1", "devices": ["hot", "quiet"]}]}}]}) for k, qt in enumerate(qtimes)])
    routed = Q.routed_queries(docs, buildings_df(spark, [B]))
    qg = E.explode_query_groups(routed)
    known = Q.query_known_devices(E.devices_of_groups(qg), reg)
    delivered = delivered_readings(log_df(spark, log), reg).where("reason IS NULL")
    got = {(r.event_id, r.device): r.reading_offset
           for r in Q.query_latest_values(known, delivered, bucket_seconds=3).collect()}

    # brute force: delivered = the last message at or before registration + all later ones
    before = [r for r in readings if r[0] <= reg_at]
    retained = max(before) if before else None
    delivered_bf = [r for r in readings if r[0] > reg_at] + ([retained] if retained else [])
    for k, qt in enumerate(qtimes):
        cands = [r for r in delivered_bf if r[2] and r[0] <= qt]
        want = max(cands)[1] if cands else None
        assert got[(5000 + k, "hot")] == want, (k, qt)
        assert got[(5000 + k, "quiet")] == 1000


@pytest.mark.parametrize("salts", [1, 7])
def test_hot_request_idle_cutoff(spark, salts):
    rnd = random.Random(11)
    start, expected, timeout = dt.datetime(2024, 1, 1), 12, 20
    asked = {u: rnd.randint(0, 50) for u in range(6)}
    users = [0] * 300 + [rnd.randint(1, 5) for _ in range(60)]
    replies = [(u, i, rnd.randint(0, 2000 if u == 0 else 200)) for i, u in enumerate(users)]
    got = {r.user_id: (r.accepted, r.complete) for r in S.gather_idle_cutoff(
        spark.createDataFrame([(u, start + dt.timedelta(seconds=t)) for u, t in asked.items()], "user_id LONG, request_ts TIMESTAMP_NTZ"),
        spark.createDataFrame([(u, i, start + dt.timedelta(seconds=t)) for u, i, t in replies],
                              "user_id LONG, event_id LONG, ts TIMESTAMP_NTZ"),
        expected, timeout, salts=salts).collect()}
    for u, t in asked.items():
        n, last = 0, t
        for at_ in sorted(x for v, _, x in replies if v == u and x > t):
            if n == expected or at_ - last > timeout:
                break
            n, last = n + 1, at_
        assert got[u] == (n, n == expected), u
    assert got[0][1] and not all(c for _, c in got.values())
