"""Property tests: the window/aggregate closed forms equal a sequential fold."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from hivewire.functions import constants as K
from hivewire.operators import registry as R
from hivewire.operators import state as S
from hivewire.operators.carry import Carry, carry_forward
from tests.helpers import at, register, requests_df

SETTINGS = settings(max_examples=4, deadline=None)


@SETTINGS
@given(st.integers(0, 10_000))
def test_carry_forward_equals_plain_fold(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for k in range(4):
        t = 0.0
        for i in range(rnd.randint(1, 40)):
            t += rnd.choice([0.5, 3, 7, 30])
            v = rnd.choice([None, None, rnd.randint(0, 9)])
            rows.append((f"k{k}", at(t), i, v))
    df = spark.createDataFrame(rows, "key STRING, ts TIMESTAMP_NTZ, seq LONG, v LONG")
    fixed = carry_forward(df, ["key"], ["ts", "seq"], [Carry("v", "incl"), Carry("v", "excl", inclusive=False)],
                          ts="ts", bucket_seconds=10).collect()
    # adaptive widths: a handful of rows per bucket, so every key spans many buckets
    adaptive = carry_forward(df, ["key"], ["ts", "seq"], [Carry("v", "incl"), Carry("v", "excl", inclusive=False)],
                             ts="ts", target_rows=3).collect()
    got = {(r.key, r.seq): (r.incl, r.excl) for r in fixed}
    assert {(r.key, r.seq): (r.incl, r.excl) for r in adaptive} == got
    want = {}
    for k in {r[0] for r in rows}:
        last = None
        for _, _, seq, v in sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2])):
            prev = last
            if v is not None:
                last = v
            want[(k, seq)] = (last, prev)
    assert got == want


@SETTINGS
@given(st.integers(0, 10_000))
def test_registration_status_equals_fold(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for eid in range(60):
        dev = f"d{rnd.randint(0, 4)}"
        grp = f"g{rnd.randint(0, 1)}"
        typ = rnd.choice(["thermostat", "battery", "toaster", "toaster"])
        rows.append((eid, eid + rnd.random() * 0.5, "b", register("b", grp, dev, typ)))
    got = {r.event_id: r.status for r in R.registration_status(requests_df(spark, rows)).collect()}
    running, want = set(), {}
    for eid, _, _, p in sorted(rows, key=lambda r: (r[1], r[0])):
        key = (p["groupId"], p["devId"])
        if key in running:
            want[eid] = K.ALREADY_RUNNING
        elif p["devType"] in ("thermostat", "battery"):
            want[eid] = K.REGISTERED
            running.add(key)
        else:
            want[eid] = K.COULD_NOT_CREATE + K.INVALID_DEVICE_NAME
    assert got == want


def battery_fold(events):
    """events sorted: ('r', pct) readings or ('c', status) commands -> expected status per event."""
    pct, status, out = 100.0, "discharging", []
    for kind, x in events:
        if kind == "c":
            status = x
        else:
            if status == "charging" and pct >= 80:
                status = "discharging"
            elif status == "discharging" and pct <= 20:
                status = "charging"
            pct = x
        out.append((pct, status))
    return out


@SETTINGS
@given(st.integers(0, 10_000))
def test_battery_state_with_commands_equals_fold(spark, seed):
    from pyspark.sql import functions as F
    rnd = random.Random(seed)
    rows = []
    for d in range(3):
        pct = 100.0
        for i in range(rnd.randint(5, 60)):
            if rnd.random() < 0.15:
                rows.append((f"d{d}", at(i), 1, i, None, rnd.choice(["charging", "discharging", "off"])))
            else:
                pct = max(0.0, min(100.0, pct + rnd.choice([-15, -9, -3, 4, 11])))
                rows.append((f"d{d}", at(i), 0, i, pct, None))
    df = spark.createDataFrame(rows, "dev STRING, ts TIMESTAMP_NTZ, kind INT, seq LONG, percentage DOUBLE, new_status STRING")
    # same closed form as reconcile_commands, on a bare event table
    order = ["ts", "kind", "seq"]
    u = carry_forward(df, ["dev"], order, [Carry("percentage", "_prev", inclusive=False)], ts="ts", bucket_seconds=7)
    prev = F.coalesce("_prev", F.lit(100.0))
    at_ = F.struct(*order)
    cross = F.when(prev <= 20, "charging").when(prev >= 80, "discharging")
    u = (u.withColumn("_x", F.when((F.col("kind") == 0) & cross.isNotNull(), F.struct(at_.alias("o"), cross.alias("s"))))
         .withColumn("_c", F.when(F.col("kind") == 1, F.struct(at_.alias("o"), F.col("new_status").alias("s")))))
    u = carry_forward(u, ["dev"], order, [Carry("_x", "x"), Carry("_c", "c"), Carry("percentage", "p")],
                      ts="ts", bucket_seconds=7)
    x, c = F.col("x"), F.col("c")
    status = (F.when(c.isNotNull() & (c.s == "off"), "off").when(x.isNotNull() & (c.isNull() | (x.o > c.o)), x.s)
              .when(c.isNotNull(), c.s).otherwise("discharging"))
    got = {(r.dev, r.seq): (r.p if r.p is not None else 100.0, r.st)
           for r in u.select("dev", "seq", "p", status.alias("st")).collect()}
    for d in {r[0] for r in rows}:
        evs = sorted([r for r in rows if r[0] == d], key=lambda r: (r[1], r[2], r[3]))
        want = battery_fold([("c", r[5]) if r[2] == 1 else ("r", r[4]) for r in evs])
        assert [got[(d, r[3])] for r in evs] == want


@SETTINGS
@given(st.integers(0, 10_000))
def test_idle_gather_equals_fold(spark, seed):
    rnd = random.Random(seed)
    reqs, reps = [], []
    for u in range(8):
        t0 = rnd.randint(0, 100)
        reqs.append((u, at(t0)))
        t = t0 - 20
        for i in range(rnd.randint(0, 9)):
            t += rnd.choice([1, 4, 9, 10, 11, 25])
            reps.append((u, u * 100 + i, at(t)))
    rq = spark.createDataFrame(reqs, "user_id LONG, request_ts TIMESTAMP_NTZ")
    rp = spark.createDataFrame(reps, "user_id LONG, event_id LONG, ts TIMESTAMP_NTZ")
    got = {r.user_id: r.accepted for r in S.gather_idle_cutoff(rq, rp, expected=5, timeout_seconds=10).collect()}
    for u, t0 in reqs:
        last, n = t0, 0
        for _, _, ts in sorted([r for r in reps if r[0] == u and r[2] > t0], key=lambda r: (r[2], r[1])):
            if n == 5 or (ts - last) > dt.timedelta(seconds=10):
                break
            n, last = n + 1, ts
        assert got[u] == n, (u, got[u], n)
