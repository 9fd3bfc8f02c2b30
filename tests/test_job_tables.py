"""Log-structured job tables: bounded files, replays, failures at any point; device
states folded in pieces; streams whose micro-batches fail at any of their writes."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hivewire.operators import command as C
from hivewire.operators import envelopes as E
from hivewire.operators import latest as L
from hivewire.operators import nested as N
from hivewire.operators import query as Q
from hivewire.operators.registry import DEVICE_KEY, building_instants
from hivewire.plans import catalog as CAT
from hivewire.sources import feeds
from hivewire.sources.topic_log import idempotent_batch_writer
from hivewire.streaming import jobs
from hivewire.streaming.gather import Gathers
from hivewire.streaming.tables import JobTable
from tests.conftest import SF_SMALL
from tests.helpers import at


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


SCHEMA = "k STRING, at INT, v STRING"


def put(table, batch_id, data):
    table.write(table.spark.createDataFrame(data, SCHEMA), batch_id)


def test_files_stay_bounded_over_many_batches(spark, tmp_path):
    r, want = random.Random(1), {}
    table = JobTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], ["at"], buckets=2, every=4)
    most = 0
    for b in range(100):
        data = [(f"k{r.randrange(12)}", b - r.choice([0, 0, 3]), f"v{b}") for _ in range(3)]
        data = list({k: (k, t, v) for k, t, v in data}.values())
        put(table, b, data)
        for k, t, v in data:
            if k not in want or (t, b) >= want[k][2]:
                want[k] = (t, v, (t, b))
        most = max(most, len(list((tmp_path / "t").rglob("*.parquet"))))
        if b % 20 == 19:
            assert {x.k: (x.at, x.v) for x in table.current().collect()} == {k: x[:2] for k, x in want.items()}
    assert most <= 40 and len(list((tmp_path / "t" / "manifests").glob("m*"))) == 2


def test_a_replayed_batch_leaves_the_same_version(spark, tmp_path):
    table = JobTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], [], buckets=2, every=3)
    for b in range(8):
        put(table, b, [("x", 0, "wrong"), (f"only{b}", 0, "wrong")])        # a first try that differs
        before = rows(table.before(b))
        again = JobTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], [], buckets=2, every=3)
        put(again, b, [("x", b, "right"), (f"k{b}", b, "right")])
        assert rows(again.before(b)) == before
    assert {x.k: (x.at, x.v) for x in table.current().collect()} == {"x": (7, "right"), **{f"k{b}": (b, "right") for b in range(8)}}


@pytest.mark.parametrize("point", ["_save", "_put", "_clean"])
def test_a_failure_at_any_point_of_a_write(spark, tmp_path, monkeypatch, point):
    table = JobTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], [], buckets=2, every=2)
    real = getattr(JobTable, point)
    for b in range(6):
        calls = [0]

        def breaking(self, *a):
            calls[0] += 1
            if calls[0] == 1 + b % 2:       # the delta or the merged base
                raise OSError("broken")
            return real(self, *a)
        monkeypatch.setattr(JobTable, point, breaking)
        before = rows(table.before(b))
        try:
            put(table, b, [("x", b, "half"), ("lost", b, "half")])
        except OSError:
            pass
        monkeypatch.setattr(JobTable, point, real)
        assert rows(table.before(b)) == before
        put(table, b, [("x", b, "whole"), (f"k{b}", b, "whole")])
    assert {x.k: (x.at, x.v) for x in table.current().collect()} == {"x": (5, "whole"), **{f"k{b}": (b, "whole") for b in range(6)}}


def test_new_keys_only_are_not_reduced(spark, tmp_path):
    table = JobTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=2, every=2)
    for b in range(5):
        put(table, b, [(f"k{b}", b, None)])
    assert "Aggregate" not in table.current()._jdf.queryExecution().executedPlan().toString()
    assert sorted(x.k for x in table.current().collect()) == [f"k{b}" for b in range(5)]
    assert JobTable(spark, str(tmp_path / "none"), SCHEMA, ["k"]).current().collect() == []


# --- states folded in pieces ------------------------------------------------------------

def directly(events):
    """The battery's and the toaster's rules, one event after the other."""
    out, state = [], {}
    for dev, kind, power, pct, value, status, at_s, seq in sorted(events, key=lambda e: (e[6], e[1], e[7])):
        if dev.startswith("battery"):
            p, s = state.get(dev, (100.0, "discharging"))
            if kind == 1:
                s = status
            else:
                s = s if s == "off" else "charging" if p <= 20 else "discharging" if p >= 80 else s
                p = pct
            state[dev] = (p, s)
            out.append((seq, p, s, None, None, None))
        else:
            limit, used, peak = state.get(dev, (100.0, 0.0, None))
            if kind == 1:
                limit = value
            else:
                used, peak = used + power, power if peak is None else max(peak, power)
            state[dev] = (limit, used, peak)
            out.append((seq, None, None, limit, used, peak))
    return sorted(out)


EVENT = ("building STRING, group_id STRING, dev_id STRING, dev_type STRING, ts TIMESTAMP_NTZ, _kind INT, seq LONG, value DOUBLE, "
         "percentage DOUBLE, power DOUBLE, set_value DOUBLE, new_status STRING")


def events_df(spark, events):
    return spark.createDataFrame([("b", "g", dev, dev.rstrip("0123456789"), at(s), kind, seq, None, pct, power, value, status)
                                  for dev, kind, power, pct, value, status, s, seq in events], EVENT)


def random_events(seed, n, devices):
    r = random.Random(seed)
    out = []
    for seq in range(n):
        dev, kind = r.choice(devices), int(r.random() < 0.2)
        battery = dev.startswith("battery")
        out.append((dev, kind, None if battery or kind else float(r.randrange(50)),
                    float(r.choice([5, 20, 50, 80, 95])) if battery and not kind else None,
                    float(r.randrange(100)) if kind and not battery else None,
                    r.choice(["off", "charging", "discharging"]) if kind and battery else None, r.randrange(900), seq))
    return out


@pytest.mark.parametrize("cuts", [[], [450], [100, 101, 500, 899]])
def test_states_fold_in_pieces(spark, cuts):
    """Each piece continues from the last states of the one before, whatever the cuts."""
    events = random_events(3, 400, ["battery1", "battery2", "toaster1", "toaster2"])
    columns = ["expected_percentage", "expected_status", "expected_limit", "expected_used", "expected_peak"]
    got, state = [], None
    for lo, hi in zip([0, *cuts], [*cuts, 900]):
        part = events_df(spark, [e for e in events if lo <= e[6] < hi])
        if state is not None:
            state = spark.createDataFrame(state, schema).withColumn("ts", F.lit(at(lo)).cast("timestamp_ntz"))
        out = C.expected_states(part, CAT.POWERED, state)
        found = out.collect()
        got += [tuple(r[c] for c in ["seq", *columns]) for r in found]
        last = {}
        if state is not None:
            last = {r.dev_id: r for r in state.drop("ts").collect()}
        for r in sorted(found, key=lambda r: (r.ts, r.kind == "command", r.seq)):
            last[r.dev_id] = r
        allc = CAT.POWERED and [*DEVICE_KEY, "dev_type", "expected_value", *columns]
        schema = "building STRING, group_id STRING, dev_id STRING, dev_type STRING, expected_value DOUBLE, expected_percentage DOUBLE, " \
                 "expected_status STRING, expected_limit DOUBLE, expected_used DOUBLE, expected_peak DOUBLE"
        state = [tuple(r[c] for c in allc) for r in last.values()]
    assert sorted(got) == directly(events)


def test_a_hot_device_is_folded_in_parts(spark):
    events = random_events(4, 3000, ["battery1"])
    out = C.expected_states(events_df(spark, events), CAT.POWERED, bucket_seconds=30)
    assert sorted(tuple(r[c] for c in ("seq", "expected_percentage", "expected_status", "expected_limit", "expected_used", "expected_peak"))
                  for r in out.collect()) == directly(events)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_cf_bucket" in plan and "Python" not in plan and "Arrow" not in plan


def test_a_mergeable_fold_is_partially_aggregated(spark):
    items = spark.createDataFrame([(k % 3, float(k)) for k in range(50)], "q INT, x DOUBLE")
    fold = Q.Fold({"n": F.count("x"), "s": F.sum("x")}, lambda p: p["s"] / p["n"])
    got = Q.gather_fold(items, ["q"], fold, "mean")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "collect_list" not in plan
    assert {r.q: r["mean"] for r in got.collect()} == {q: sum(range(q, 50, 3)) / len(range(q, 50, 3)) for q in range(3)}


# --- streams: live buildings, failures at every write --------------------------------------

def live(c, raw, body, **how):
    return E.route_as_of(E.explode_envelope(raw, body, last_wins=True, **how), c.live_buildings)


def answers(c):
    routed = live(c, c.queries_raw, E.QUERY_BODY)
    groups = E.explode_query_groups(routed)
    known = Q.query_known_devices(E.devices_of_groups(groups), c.registry)
    replies = Q.query_replies(groups, Q.asked_readings(c.telemetry, known, c.registry, c.types), c.registry, c.groups, c.types)
    return CAT.results_text(replies, groups)


def statuses(c):
    routed = live(c, c.commands_raw, E.COMMAND_BODY, keep_text=True)
    return C.gather_command_status(C.command_rows(routed, c.groups, c.registry, c.types))


def states(c):
    routed = live(c, c.commands_raw, E.COMMAND_BODY, keep_text=True)
    valid = L.valid_readings(c.telemetry, c.registry, c.types).where("ts > reg_ts")
    events = C.device_events(valid, C.validate_commands(routed, c.groups, c.registry, c.types), c.types)
    return C.expected_states(events, c.types).drop("ts")


def nested_answers(c):
    groups = E.explode_query_groups(live(c, c.queries_raw, E.QUERY_BODY))
    return N.two_level_gather(N.asked_groups(groups, c.registry, c.groups), CAT.device_replies(c, groups))


class Broken(Exception):
    pass


def breaking(monkeypatch, fail_at, after):
    """Writes of outputs and tables are counted; one fails, before or after it is done."""
    count, failures = [0], []

    def step(write):
        count[0] += 1
        mine = count[0]
        if mine == fail_at and not after:
            raise Broken
        write()
        if mine == fail_at and after:
            raise Broken

    def writer(path, topic_col=None):
        real = idempotent_batch_writer(path, topic_col)
        return lambda batch, batch_id: step(lambda: real(batch, batch_id))

    real_write, drain = JobTable.write, jobs._drain

    def retrying(w):
        try:
            drain(w)
        except StreamingQueryException as e:
            failures.append(e)
            drain(w)

    monkeypatch.setattr(jobs, "idempotent_batch_writer", writer)
    monkeypatch.setattr(JobTable, "write", lambda self, df, batch_id, *a: step(lambda: real_write(self, df, batch_id, *a)))
    monkeypatch.setattr(jobs, "_drain", retrying)
    return failures


CASES = [
    (jobs.stream_ingest, CAT.encode_telemetry, 5), (jobs.stream_latest, CAT.latest_per_device, 4),
    (jobs.stream_query_answers, answers, 8), (jobs.stream_command_status, statuses, 6), (jobs.stream_device_state, states, 5),
    (jobs.stream_device_attempts, CAT.device_attempts, 6), (jobs.stream_two_level_gather, nested_answers, 9)]


@pytest.mark.parametrize("stream,batch,fail_at,after", [
    (s, b, k if i % 2 else k + n, (i + k) % 3 == 0) for i, (s, b, n) in enumerate(CASES)
    for k in ((1, n) if n < 9 else (n,))])
def test_streams_survive_a_failed_write(spark, monkeypatch, stream, batch, fail_at, after):
    """At the first and the last write of a micro-batch (the first or the second one)."""
    failures = breaking(monkeypatch, fail_at, after)
    got = rows(stream(spark, SF_SMALL))
    assert len(failures) == 1
    assert got == rows(batch(CAT.Ctx(spark, SF_SMALL)))


def test_a_building_gets_only_documents_after_its_registration(spark):
    entries = spark.createDataFrame([(i, at(s), b) for i, (s, b) in enumerate([
        (0, "old"), (5, "new"), (10, "new"), (11, "new"), (9, "never")])], "event_id LONG, ts TIMESTAMP_NTZ, building STRING")
    seed = spark.createDataFrame([("old", "r")], "building STRING, region STRING")
    requests = spark.createDataFrame([(1, at(10), "new", "r"), (2, at(30), "new", "q"), (3, at(5), "old", "q")],
                                     "event_id LONG, ts TIMESTAMP_NTZ, building STRING, region STRING")
    got = E.route_as_of(entries, building_instants(seed, requests))
    assert got.columns == entries.columns and sorted(r.event_id for r in got.collect()) == [0, 2, 3]


def test_a_region_follows_buildings_as_they_register(spark, monkeypatch):
    """Also when a micro-batch fails; nothing of a building is seen before, nothing twice."""
    monkeypatch.setattr(feeds, "buildings", lambda spark, sf: feeds.all_buildings(spark, sf, "n_nationkey < 3"))
    failures = breaking(monkeypatch, 6, True)
    got = rows(jobs.stream_region_view(spark, SF_SMALL))
    c = CAT.Ctx(spark, SF_SMALL)
    seed = {(r.region, r.building) for r in c.buildings.collect()}
    since = {}
    for r in c.building_requests.collect():
        since[r.region, r.building] = min(since.get((r.region, r.building), r.ts), r.ts)
    want = []
    regions = seed | set(since)
    reg = {(r.building, r.group_id, r.dev_id): r.reg_ts for r in c.registry.collect()}
    for r in L.delivered_readings(c.telemetry, c.registry, c.types).where("reason IS NULL").collect():
        when = max(r.ts, reg[r.building, r.group_id, r.dev_id])
        want += [(r.building, r.msg_offset, "data", f"Data-{r.building}", g) for g, b in regions
                 if b == r.building and ((g, b) in seed or since[g, b] <= when)]
    assert len(failures) == 1 and any(k not in seed for k in regions)
    assert [x for x in got if x[2] == "data"] == sorted(want, key=str)


# --- gathers -----------------------------------------------------------------------------------

GATHER = "user_id LONG, event_id LONG, ts TIMESTAMP_NTZ, event_type STRING"


def gather(spark, path, batches, **how):
    """Fold literal micro-batches of (user, event, second, type); (closed, late rows) per batch."""
    g = Gathers(spark, str(path), how.pop("expected", 3), how.pop("timeout", 10), lateness_s=how.pop("lateness", 5), **how)
    out = []
    for b, data in enumerate(batches):
        df = spark.createDataFrame([(u, e, at(s), t) for u, e, s, t in data], GATHER)
        done, late, writes = g.fold(df, b)
        out.append((sorted((r.user_id, r.accepted, r.complete) for r in done.collect()), sorted(r.event_id for r in late.collect())))
        for table, *rest in writes:
            table.write(rest[0], b, *rest[1:])
    return g, out


def test_gathers_close_at_the_count_or_when_silent(spark, tmp_path):
    _, out = gather(spark, tmp_path, [
        [(1, 1, 0, "purchase"), (2, 2, 1, "purchase"), (1, 3, 4, "view"), (3, 4, 4, "view")],
        [(1, 5, 8, "view"), (1, 6, 9, "view"), (1, 7, 9, "view"), (2, 8, 10, "view"), (1, 9, 9, "purchase")],
        [(2, 10, 21, "view"), (4, 11, 22, "purchase")],
        [(9, 12, 60, "tick")]])
    assert [done for done, _ in out] == [[], [(1, 3, True)], [(2, 1, False)], [(4, 0, False)]]


def test_late_rows_are_in_the_quarantine(spark, tmp_path):
    _, out = gather(spark, tmp_path, [
        [(1, 1, 0, "purchase"), (9, 2, 8, "tick")],
        [(1, 3, 2, "view"), (1, 4, 3, "view")],         # event time was 8 - 5: second 2 is late, second 3 is not
        [(9, 5, 40, "tick")]])
    assert [late for _, late in out] == [[], [3], []] and out[2][0] == [(1, 1, False)]


def test_markers_of_closed_gathers_expire(spark, tmp_path):
    batches = [[(u, u, 0, "purchase") for u in range(5)]] + [[(9, 100 + b, 30 * b, "tick")] for b in range(1, 8)]
    g, out = gather(spark, tmp_path, batches, ttl_s=20, buckets=2, every=2)
    assert out[1][0] == [(u, 0, False) for u in range(5)] and g.table.current().count() == 0
    g, _ = gather(spark, tmp_path / "kept", batches, buckets=2, every=2)
    assert g.table.current().count() == 5


def test_a_hot_request_is_cut_before_its_replies_meet(spark, tmp_path):
    hot = [(1, 0, 0, "purchase")] + [(1, e, 1 + e / 1000, "view") for e in range(1, 3000)]
    g = Gathers(spark, str(tmp_path), 3, 10, salts=4)
    opened = spark.createDataFrame([(1, at(0), at(0), 0)], "user_id LONG, request_ts TIMESTAMP_NTZ, last_ts TIMESTAMP_NTZ, accepted LONG")
    r = g.first_replies(spark.createDataFrame([(u, e, at(s), t) for u, e, s, t in hot], GATHER), opened)
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("row_number()") >= 2 and "_salt" in plan and sorted(x.event_id for x in r.collect()) == [1, 2, 3]
    _, out = gather(spark, tmp_path / "s", [hot])
    assert out[0][0] == [(1, 3, True)]
