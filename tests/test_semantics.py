"""One named test per exact-semantics item of the blueprint (§2.11)."""

import json

from hivewire.operators import command as C
from hivewire.operators import decode as D
from hivewire.operators import envelopes as E
from hivewire.operators import query as Q
from hivewire.operators import registry as R
from hivewire.operators import state as S
from hivewire.operators.devices import BATTERY, THERMOSTAT, DeviceType, Field, Registry
from hivewire.operators.latest import delivered_readings, latest_per_device, replay_since_registration
from tests.helpers import buildings_df, docs_df, log_df, register, requests_df

B = "b1"
PATH = "/b1/g1/t/d1"


def thermo(v, ts="t"):
    return {"deviceId": "d1", "value": v, "unit": "Celsius", "timestamp": ts}


def battery(p, status="discharging"):
    return {"deviceId": "d1", "percentage": p, "status": status, "timestamp": "t"}


def test_01_registration_order_of_checks(spark):
    reqs = requests_df(spark, [
        (1, 1, B, register(B, "g1", "d1", "toaster")),
        (2, 2, B, register(B, "g1", "d1", "thermostat")),
        (3, 3, B, register(B, "g1", "d1", "toaster")),
        (4, 4, B, register(B, "g1", "d1", "battery")),
        (5, 5, B, '{"groupId":"g1"}')])
    st = {r.event_id: r.status for r in R.registration_status(reqs).collect()}
    assert st == {1: "COULD NOT CREATE DEVICE: INVALID DEVICE NAME", 2: "REGISTERED",
                  3: "DEVICE ALREADY RUNNING", 4: "DEVICE ALREADY RUNNING"}
    reg = R.device_registry(reqs).collect()
    assert [(r.dev_type, r.reg_event_id) for r in reg] == [("thermostat", 2)]


def _query(spark, body, reqs, telemetry=None, ts=100):
    reg, groups = R.device_registry(reqs), R.list_groups(reqs)
    routed = Q.routed_queries(docs_df(spark, [(900, ts, {"buildings": [{"building": B, "groupList": body}]})]),
                              buildings_df(spark, [B]))
    qg = E.explode_query_groups(routed)
    tel = telemetry if telemetry is not None else log_df(spark, [(0, 0, "/x", "{}")])
    readings = delivered_readings(tel, reg).where("reason IS NULL")
    res = Q.gather_query_results(Q.query_replies(qg, readings, reg, groups), qg).collect()
    comp = Q.gather_completeness(qg, groups).collect()
    return res[0].results, comp[0]


def test_02_group_exists_without_valid_device(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "toaster"))])
    items, comp = _query(spark, {"queryId": "q", "groups": [{"group": "g1", "devices": ["d1"]},
                                                             {"group": "nope", "devices": ["d1"]}]}, reqs)
    assert [json.loads(i.json) for i in items] == [{"error": "No devices found for group g1"}]
    assert (comp.expected_groups, comp.received_groups, comp.complete) == (2, 1, False)
    # commands: the unmentioned group is an error, the mentioned one exists
    routed = C.routed_commands(docs_df(spark, [(901, 100, {"buildings": [{"building": B, "cmdList": {"commands": [
        {"groupId": "g1", "devices": [{"deviceId": "d1", "command": {}}]},
        {"groupId": "nope", "devices": []}]}}]})]), buildings_df(spark, [B]))
    st = C.command_dispatch_status(routed, R.list_groups(reqs), R.device_registry(reqs)).collect()
    assert sorted(r.message for r in st) == ["Device d1 does not exist", "Group nope does not exist"]


def test_03_unknown_devices_omitted_duplicates_kept(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    items, comp = _query(spark, {"queryId": "q", "groups": [{"group": "g1", "devices": ["d1", "x", "d1"]},
                                                             ]}, reqs)
    assert [i.device for i in items] == ["d1", "d1"]
    assert comp.complete
    items, _ = _query(spark, {"queryId": "q", "groups": [{"group": "g1", "devices": ["x", "y"]}]}, reqs)
    assert [json.loads(i.json) for i in items] == [{"error": "No devices found for group g1"}]


def test_04_unknown_group_and_zero_groups_are_partial(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    _, comp = _query(spark, {"queryId": "q", "groups": [{"group": "zz", "devices": ["d1"]}]}, reqs)
    assert (comp.expected_groups, comp.received_groups, comp.complete) == (1, 0, False)
    items, comp = _query(spark, {"queryId": "q", "groups": []}, reqs)
    assert items == [] and comp.expected_groups == 0 and not comp.complete


def test_05_idle_timeout_is_rearmed_per_reply(spark):
    from tests.helpers import at
    req = spark.createDataFrame([(1, at(0))], "user_id LONG, request_ts TIMESTAMP_NTZ")
    rep = spark.createDataFrame([(1, i, at(s)) for i, s in enumerate([5, 14, 23, 40, 41])],
                                "user_id LONG, event_id LONG, ts TIMESTAMP_NTZ")
    out = S.gather_idle_cutoff(req, rep, expected=5, timeout_seconds=10).collect()[0]
    # gaps 5, 9, 9 accepted (total 23 s > timeout, but idle time never exceeded it); 17 s gap stops
    assert (out.accepted, out.complete) == (3, False)


def test_06_latest_is_arrival_order_not_payload_time(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    tel = log_df(spark, [(10, 5, PATH, thermo(1.0, "2030-01-01T00:00:00")),
                         (11, 6, PATH, thermo(2.0, "2000-01-01T00:00:00"))])
    assert [r.value for r in latest_per_device(tel, R.device_registry(reqs)).collect()] == [2.0]


def test_07_no_data_yet(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    items, _ = _query(spark, {"queryId": "q", "groups": [{"group": "g1", "devices": ["d1"]}]}, reqs)
    assert json.loads(items[0].json) == {"deviceId": "d1", "data": "NO DATA YET"}


def test_07b_value_as_of_query_time_and_retained_message(spark):
    reqs = requests_df(spark, [(1, 10, B, register(B, "g1", "d1", "thermostat", PATH))])
    tel = log_df(spark, [(1, 2, PATH, thermo(1.0)), (2, 5, PATH, thermo(2.0)),  # 2.0 is retained at t=10
                         (3, 50, PATH, thermo(3.0)), (4, 200, PATH, thermo(4.0))])
    j3 = sorted(r.msg_offset for r in replay_since_registration(tel, R.device_registry(reqs)).collect())
    assert j3 == [2, 3, 4]
    items, _ = _query(spark, {"queryId": "q", "groups": [{"group": "g1", "devices": ["d1"]}]}, reqs, tel, ts=100)
    assert json.loads(items[0].json)["value"] == 3.0


def test_08_outputs_are_valid_json(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    reg, groups = R.device_registry(reqs), R.list_groups(reqs)
    routed = Q.routed_queries(docs_df(spark, [(9, 100, {"buildings": [{"building": B, "groupList": {
        "queryId": "q", "groups": [{"group": "g1", "devices": ["d1"]}]}}]})]), buildings_df(spark, [B]))
    qg = E.explode_query_groups(routed)
    readings = delivered_readings(log_df(spark, [(0, 0, "/x", "{}")]), reg).where("reason IS NULL")
    msg = Q.query_results_json(Q.gather_query_results(Q.query_replies(qg, readings, reg, groups), qg)).collect()[0]
    doc = json.loads(msg.value)
    assert doc["buildingId"] == B and doc["queryId"] == "q" and doc["results"][0]["data"] == "NO DATA YET"


def test_09_documents_are_all_or_nothing(spark):
    docs = docs_df(spark, [
        (1, 1, {"buildings": [{"building": B, "groupList": {}}, {"building": "b2"}]}),
        (2, 2, {"buildings": [{"building": B, "groupList": {}}, {"building": 7, "groupList": {}}]}),
        (3, 3, "not json"),
        (4, 4, {"buildings": [{"building": B, "groupList": {"queryId": "q", "groups": []}}]})])
    good = E.explode_envelope(docs, E.QUERY_BODY)
    assert [r.event_id for r in good.collect()] == [4]
    bad = E.envelope_quarantine(E.decode_envelope(docs, E.QUERY_BODY))
    assert sorted(r.event_id for r in bad.collect()) == [1, 2, 3]
    # a bad group inside a building query rejects that whole query
    entries = E.explode_envelope(docs_df(spark, [(5, 5, {"buildings": [{"building": B, "groupList": {
        "queryId": "q", "groups": [{"group": "g", "devices": ["a"]}, {"group": "h", "devices": [1]}]}}]})]),
        E.QUERY_BODY)
    assert E.explode_query_devices(entries).count() == 0
    assert E.query_quarantine(entries).count() == 1


def test_10_dispatch_does_not_validate(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    routed = C.routed_commands(docs_df(spark, [(9, 100, {"buildings": [{"building": B, "cmdList": {"commands": [
        {"groupId": "g1", "devices": [{"deviceId": "d1", "command": {"name": "set", "value": 99}}]}]}}]})]),
        buildings_df(spark, [B]))
    reg, groups = R.device_registry(reqs), R.list_groups(reqs)
    st = C.command_dispatch_status(routed, groups, reg).collect()
    assert [(r.ok, r.message, r.cmd_topic) for r in st] == [(True, "Command published sucessfully for d1", PATH + "/cmd")]
    v = C.validate_commands(routed, groups, reg).collect()
    assert [(r.valid, r.reason) for r in v] == [(False, "Cannot set thermostat value out of normal range!")]


def test_11_command_range_inclusive_readings_unchecked(spark):
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "thermostat", PATH))])
    cmds = [{"deviceId": "d1", "command": {"name": "set", "value": v}} for v in (-10, 40, 40.01, -10.5)]
    routed = C.routed_commands(docs_df(spark, [(9, 100, {"buildings": [{"building": B, "cmdList": {
        "commands": [{"groupId": "g1", "devices": cmds}]}}]})]), buildings_df(spark, [B]))
    v = sorted(C.validate_commands(routed, R.list_groups(reqs), R.device_registry(reqs)).collect(),
               key=lambda r: r.device_pos)
    assert [r.valid for r in v] == [True, True, False, False]
    tel = log_df(spark, [(1, 1, PATH, thermo(500.0))])
    assert D.decode_thermostat(tel).collect()[0].reason is None
    assert D.decode_battery(log_df(spark, [(1, 1, PATH, battery(100.5))])).collect()[0].reason == "range"


def test_12_battery_status_uses_previous_reading(spark):
    path = "/b1/g1/s/d1"
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "d1", "battery", path))])
    pcts = [50, 20, 30, 85, 60]
    tel = log_df(spark, [(i, 10 + i, path, battery(p)) for i, p in enumerate(pcts)])
    rows = sorted(S.battery_expected_status(tel, R.device_registry(reqs)).collect(), key=lambda r: r.msg_offset)
    # previous 100 -> discharging; 50 -> keep; 20 -> charging; 30 -> keep; 85 -> discharging
    assert [r.expected_status for r in rows] == ["discharging", "discharging", "charging", "charging", "discharging"]


def test_13_null_numbers(spark):
    tel = log_df(spark, [(1, 1, PATH, thermo(None)), (2, 2, PATH, battery(None))])
    t = D.decode_thermostat(tel).collect()[0]
    assert t.reason is None and t.value is None
    # the reading is still published, its number written as null
    from hivewire.operators.latest import encode_telemetry
    reqs = requests_df(spark, [(0, 0, B, register(B, "g1", "d1", "thermostat", PATH))])
    enc = encode_telemetry(tel.where("msg_offset = 1"), R.device_registry(reqs)).collect()
    assert [json.loads(r.json) for r in enc] == [{"deviceId": "d1", "value": None, "unit": "Celsius", "timestamp": "t"}]
    b = D.decode_battery(tel).collect()[1]
    assert b.reason == "range"


def test_14_strict_types_and_reason_order(spark):
    tel = log_df(spark, [
        (1, 1, PATH, '{"deviceId":'),
        (2, 2, PATH, '[1, 2]'),
        (3, 3, PATH, {"deviceId": 5, "value": 1}),
        (4, 4, PATH, {"deviceId": "d", "value": "1.5", "unit": "C", "timestamp": "t"}),
        (5, 5, PATH, {"deviceId": "d", "value": 1, "unit": "C", "timestamp": "t", "extra": [1]})])
    got = {r.msg_offset: r.reason for r in D.decode_thermostat(tel).collect()}
    assert got == {1: "malformed", 2: "malformed", 3: "deviceId", 4: "value", 5: None}


def test_a_plugged_in_type_keeps_its_own_fields(spark):
    """A type with a field that no default type has, through A3, J6 and A4."""
    hygro = DeviceType("hygro", (Field("deviceId", "string"), Field("humidity", "number"), Field("timestamp", "string")))
    types = Registry((THERMOSTAT, BATTERY, hygro))
    path = f"/{B}/g1/air/h1"
    reqs = requests_df(spark, [(1, 1, B, register(B, "g1", "h1", "hygro", path))])
    tel = log_df(spark, [(1, 5, path, {"deviceId": "h1", "humidity": 41.5, "timestamp": "t"}),
                         (2, 9, path, {"deviceId": "h1", "humidity": "wet", "timestamp": "t"})])
    reg, groups = R.device_registry(reqs, types), R.list_groups(reqs)
    assert [r.humidity for r in latest_per_device(tel, reg, types).collect()] == [41.5]
    routed = Q.routed_queries(docs_df(spark, [(9, 100, {"buildings": [{"building": B, "groupList": {
        "queryId": "q", "groups": [{"group": "g1", "devices": ["h1"]}]}}]})]), buildings_df(spark, [B]))
    qg = E.explode_query_groups(routed)
    known = Q.query_known_devices(E.devices_of_groups(qg), reg)
    readings = Q.asked_readings(tel, known, reg, types)
    assert [r.humidity for r in Q.query_latest_values(known, readings, types).collect()] == [41.5]
    res = Q.gather_query_results(Q.query_replies(qg, readings, reg, groups, types), qg).collect()[0].results
    assert json.loads(res[0].json) == {"deviceId": "h1", "humidity": 41.5, "timestamp": "t"}
