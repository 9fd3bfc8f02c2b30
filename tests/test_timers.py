"""Two-level gathers and registration attempts against simulations, whole and cut
into micro-batches whose rows arrive out of order within the lateness."""

import heapq
import random

import pytest

from hivewire.functions import constants as K
from hivewire.operators import nested as N
from hivewire.streaming.timers import Attempts, NestedGathers
from tests.helpers import at

ASKED = ("event_id LONG, building STRING, query_id STRING, group_pos LONG, ts TIMESTAMP_NTZ, `group` STRING, known BOOLEAN, "
         "expected LONG, n_devices LONG")
REPLIES = "event_id LONG, building STRING, query_id STRING, group_pos LONG, device_pos LONG, ts TIMESTAMP_NTZ, text STRING"
MESSAGES = "kind STRING, event_id LONG, ts TIMESTAMP_NTZ, building STRING, dev_id STRING, status STRING"


def asked_df(spark, data):
    """(query, group_pos, second, known, expected, n_devices)."""
    return spark.createDataFrame([(q, "b", f"q{q}", p, at(s), None if p == N.NO_GROUP else f"g{p}", k, e, n)
                                  for q, p, s, k, e, n in data], ASKED)


def replies_df(spark, data):
    """(query, group_pos, device_pos, second, text)."""
    return spark.createDataFrame([(q, "b", f"q{q}", p, d, at(s), t) for q, p, d, s, t in data], REPLIES)


def answers(df):
    return sorted((r.event_id, r.answered_at, r.expected_groups, r.received_groups, r.complete, r.n_items, r["items"])
                  for r in df.collect())


def idle(times, start, expected, timeout):
    """What an idle gather of sorted (time, ...) takes: its last time, how many."""
    last, n = start, 0
    for t, *_ in times:
        if n == expected or t - last > timeout:
            break
        last, n = t, n + 1
    return last, n


def simulated(asked, replies):
    out = []
    for q in sorted({a[0] for a in asked}):
        start = next(a[2] for a in asked if a[0] == q)
        groups, total = [], 0
        for _, p, _, known, expected, n in [a for a in asked if a[0] == q]:
            total += p != N.NO_GROUP
            if not known:
                continue
            if expected == 0:
                groups.append((start, p, [(p, -1, f"error:g{p}::-")]))
                continue
            first = {}
            for _, _, d, s, t in [r for r in replies if r[:2] == (q, p) and 0 <= r[2] < n and r[3] >= start]:
                first[d] = min(first.get(d, (s, t)), (s, t))
            got = sorted((s, d, t) for d, (s, t) in first.items())
            last, k = idle(got, start, expected, N.GROUP_SECONDS)
            groups.append((last if k == expected else last + N.GROUP_SECONDS, p, [(p, d, t) for _, d, t in got[:k]]))
        groups.sort()
        last, k = idle(groups, start, total, N.BUILDING_SECONDS)
        complete = k == total and total > 0
        items = sorted(i for g in groups[:k] for i in g[2])
        out.append((q, at(last if complete else last + N.BUILDING_SECONDS), total, k, complete, len(items), ";".join(i[2] for i in items)))
    return out


def random_queries(seed):
    r = random.Random(seed)
    asked, replies = [], []
    for q in range(25):
        start, n_groups = r.randrange(100), r.choice([0, 1, 1, 2, 3])
        if not n_groups:
            asked.append((q, N.NO_GROUP, start, False, 0, 0))
        for p in range(n_groups):
            n = r.randrange(4)
            silent = r.random() < 0.2
            asked.append((q, p, start, r.random() < 0.8, n, n))
            t = start
            for d in range(n):
                t += r.choice([0, 1, 2, 4, 5, 5, 6, 9])
                if not silent and r.random() < 0.9:
                    replies += [(q, p, d, t + again, f"{d}@{again}") for again in range(r.choice([1, 1, 2]))]
            replies.append((q, p, 7, start + 1, "not asked"))
    return asked, replies + [(99, 0, 0, 50, "no query")]


def test_a_silent_device_and_a_silent_group(spark):
    asked = [(1, 0, 0, True, 2, 2), (1, 1, 0, True, 1, 1),              # one device of group 0 is silent, group 1 is
             (2, 0, 0, True, 2, 2), (2, 1, 0, False, 0, 1),             # group 1 does not exist
             (3, 0, 0, True, 1, 1), (3, 1, 0, True, 0, 1),              # group 1 has no known device
             (4, N.NO_GROUP, 0, False, 0, 0), (5, 0, 0, True, 3, 3)]
    replies = [(1, 0, 0, 2, "a"), (2, 0, 0, 3, "a"), (2, 0, 1, 7, "b"), (3, 0, 0, 5, "a"),
               (5, 0, 0, 5, "a"), (5, 0, 1, 10, "b"), (5, 0, 2, 15, "late for the building")]
    got = {a[0]: a[1:] for a in answers(N.two_level_gather(asked_df(spark, asked), replies_df(spark, replies)))}
    assert got == {
        1: (at(7), 2, 2, True, 1, "a"),                 # group 1 answers at 5 with nothing, group 0 at 2 + 5 with one
        2: (at(17), 2, 1, False, 2, "a;b"),             # 7 + 10
        3: (at(5), 2, 2, True, 2, "a;error:g1::-"),
        4: (at(10), 0, 0, False, 0, ""),
        5: (at(10), 1, 0, False, 0, "")}                # the group is done at 15, the building has given up at 10


@pytest.mark.parametrize("seed", [1, 2])
def test_gathers_equal_a_simulation(spark, seed):
    asked, replies = random_queries(seed)
    assert answers(N.two_level_gather(asked_df(spark, asked), replies_df(spark, replies))) == simulated(asked, replies)
    plan = N.two_level_gather(asked_df(spark, asked), replies_df(spark, replies))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan and "Python" not in plan


def arrivals(rows, second, cuts, seed, lateness):
    """Rows by micro-batch: a row arrives up to the lateness after its time."""
    r = random.Random(seed)
    batches = [[] for _ in range(len(cuts) + 1)]
    for row in rows:
        came = row[second] + r.random() * lateness
        batches[sum(came >= c for c in cuts)].append(row)
    return batches


def run(fold, writes_of, batches):
    out = []
    for b, data in enumerate(batches):
        first, second, writes = fold(b, data)
        out.append((writes_of(first), second.collect()))
        for table, df, *keep in writes:
            table.write(df, b, *keep)
    return out


def test_gathers_in_micro_batches(spark, tmp_path):
    asked, replies = random_queries(3)
    cuts, lateness = [20, 50, 70, 115], 6
    a, r = arrivals(asked, 2, cuts, 1, lateness), arrivals(replies, 3, cuts, 2, lateness)
    gathers = NestedGathers(spark, str(tmp_path), lateness_s=lateness, buckets=2, every=2)
    batches = [(x, y, None) for x, y in zip(a, r)] + [([], [], 1000)]

    def fold(b, data):
        new, came, tick = asked_df(spark, data[0]), replies_df(spark, data[1]), data[2]
        log = new.select("ts").unionByName(came.select("ts"))
        if tick:
            log = log.unionByName(spark.createDataFrame([(at(tick),)], "ts TIMESTAMP_NTZ"))
        return gathers.fold(log, new, came, b, lambda df: df.persist())
    out = run(fold, answers, batches)
    assert sorted(x for done, _ in out for x in done) == simulated(asked, replies)      # every query once
    assert sum(bool(done) for done, _ in out) > 2
    strays = [s for _, late in out for s in late]
    assert {s.text for s in strays} >= {"not asked", "no query"}
    assert gathers.asked.current().where("NOT closed").count() == gathers.replies.current().where("NOT closed").count() == 0


def test_a_reply_may_come_before_its_query(spark, tmp_path):
    gathers = NestedGathers(spark, str(tmp_path), lateness_s=30)
    batches = [([], [(1, 0, 0, 12, "early"), (2, 0, 0, 12, "nobody's")]), ([(1, 0, 10, True, 1, 1)], []), ([(3, N.NO_GROUP, 500, False, 0, 0)], []),
               ([], [(1, 0, 0, 13, "too late"), (9, 0, 0, 600, "clock")])]

    def fold(b, data):
        new, came = asked_df(spark, data[0]), replies_df(spark, data[1])
        return gathers.fold(new.select("ts").unionByName(came.select("ts")), new, came, b)
    out = run(fold, answers, batches)
    assert [len(done) for done, _ in out] == [0, 0, 1, 1] and out[2][0] == [(1, at(12), 1, 1, True, 1, "early")]
    assert [[s.text for s in late] for _, late in out] == [[], [], ["nobody's"], ["too late"]]


# --- registration attempts ---------------------------------------------------------------------

BAD = K.COULD_NOT_CREATE + K.INVALID_DEVICE_NAME


def random_attempts(seed):
    r = random.Random(seed)
    requests, replies = [], []
    for e in range(150):
        s = r.randrange(200)
        requests.append((e, s, f"d{r.randrange(6)}"))
        if r.random() < 0.7:
            replies.append((e, s + r.choice([0, 1, 3, 5, 6, 20]), requests[-1][2],
                            r.choice([BAD] * 6 + [K.REGISTERED]) if s < 150 else K.ALREADY_RUNNING))
    return requests, [x for x in replies if x[2] != "d5" or x[3] == BAD]


def machine(requests, replies, timeout):
    """Every device, message by message; at one time: good replies, others, timers, requests."""
    events = [(s, 0 if st != BAD else 1, e, d) for e, s, d, st in replies] + [(s, 3, e, d) for e, s, d in requests]
    heapq.heapify(events)
    state, answered = {}, {}
    for e, s, d, _ in replies:
        answered[e] = min(s, answered.get(e, s))
    first = {}
    for e, s, d in requests:
        first[d] = min(s, first.get(d, s))
        state.setdefault(d, [None, 0, 0, 0])
    while events:
        s, what, e, d = heapq.heappop(events)
        x = state[d]
        if what == 0 and x[0] is None:
            x[0] = s
        elif x[0] is None and what == 1:
            x[2] += 1
        elif x[0] is None and what == 2:
            x[3] += not (e in answered and answered[e] <= s)
        elif x[0] is None and what == 3:
            x[1] += 1
            heapq.heappush(events, (s + timeout, 2, e, d))
    return sorted((d, at(first[d]), x[0] is not None and at(x[0]), *x[1:], "registering" if x[0] is None else "running")
                  for d, x in state.items())


def devices(df):
    return sorted((r.dev_id, r.first_request_ts, r.running_since or False, r.n_attempts, r.n_rejected, r.n_timeouts, r.state)
                  for r in df.collect())


def messages_df(spark, requests, replies, tick=None):
    rows = [("request", e, at(s), "b", d, None) for e, s, d in requests] + [("reply", e, at(s), "b", d, st) for e, s, d, st in replies]
    return spark.createDataFrame(rows + ([("tick", None, at(tick), None, None, None)] if tick else []), MESSAGES)


@pytest.mark.parametrize("seed", [1, 2])
def test_attempts_equal_a_state_machine(spark, seed):
    requests, replies = random_attempts(seed)
    m = messages_df(spark, requests, replies)
    got = devices(N.device_attempts(m.where("kind = 'request'").drop("kind", "status"), m.where("kind = 'reply'").drop("kind"), 5))
    assert got == machine(requests, replies, 5)
    assert {x[-1] for x in got} == {"registering", "running"}


def test_attempts_in_micro_batches(spark, tmp_path):
    requests, replies = random_attempts(4)
    cuts, lateness = [40, 90, 100, 160], 8
    a, r = arrivals(requests, 1, cuts, 1, lateness), arrivals(replies, 1, cuts, 2, lateness)
    attempts = Attempts(spark, str(tmp_path), 5, lateness_s=lateness, buckets=2, every=2)

    def fold(b, data):
        m = messages_df(spark, *data)
        return attempts.fold(m, m.where("kind <> 'tick'"), b, lambda df: df.persist())
    kinds = lambda df: [(x.dev_id, x.transition, x.at, x.event_id) for x in df.collect()]       # noqa: E731
    out = run(fold, kinds, [(x, y) for x, y in zip(a, r)] + [([], [], 2000)])
    want = machine(requests, replies, 5)
    assert devices(attempts.current()) == want and not any(late for _, late in out)
    seen = [x for done, _ in out for x in done]
    count = lambda what: sum(x[1] == what for x in seen)        # noqa: E731
    assert len(seen) == len(set(seen))
    assert (count("running"), count("rejected"), count("timed out")) == (
        sum(x[2] is not False for x in want), sum(x[4] for x in want), sum(x[5] for x in want))
    assert attempts.timers.current().where("open").count() == 0


def test_messages_behind_event_time_are_in_the_quarantine(spark, tmp_path):
    attempts = Attempts(spark, str(tmp_path), 5, lateness_s=10)

    def fold(b, data):
        m = messages_df(spark, *data)
        return attempts.fold(m, m, b)
    out = run(fold, lambda df: df.count(), [([(1, 100, "d")], []), ([(2, 80, "d"), (3, 95, "d")], []), ([(4, 300, "d")], [])])
    assert [[x.event_id for x in late] for _, late in out] == [[], [2], []]
    assert devices(attempts.current()) == [("d", at(95), False, 2, 0, 2, "registering")]
