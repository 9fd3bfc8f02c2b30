"""Invented documents with hand-computed expectations: two buildings, both
device types, an unknown group, an unknown device, an empty command."""

import json

from hivewire.operators import command as C
from hivewire.operators import envelopes as E
from hivewire.operators import query as Q
from hivewire.operators import registry as R
from hivewire.operators.latest import delivered_readings, encode_telemetry, latest_per_device
from hivewire.sources.topic_log import load_device_inventory
from tests.helpers import at, buildings_df, docs_df, log_df, requests_df

# Three devices in the harbour office, one in the mill.
HARBOUR = """{"buildingId": "harbour", "devices": [
  {"deviceType": "battery", "deviceId": "cell-a", "module": "roof", "publishingTopic": "power", "dataSendingPeriod": 30},
  {"deviceType": "thermostat", "deviceId": "hall", "module": "ground", "publishingTopic": "heat", "dataSendingPeriod": 2.5},
  {"deviceType": "thermostat", "deviceId": "kitchen", "module": "ground", "publishingTopic": "heat", "dataSendingPeriod": 2.5}]}"""
MILL = """{"buildingId": "mill", "devices": [
  {"deviceType": "battery", "deviceId": "cell-z", "module": "wheel", "publishingTopic": "power", "dataSendingPeriod": 60}]}"""

ASK = """{"buildings": [
  {"building": "mill", "groupList": {"queryId": "morning", "groups": [{"group": "wheel", "devices": ["cell-z", "cell-y"]}]}},
  {"building": "harbour", "groupList": {"queryId": "morning", "groups": [
     {"group": "ground", "devices": ["kitchen", "hall"]}, {"group": "cellar", "devices": ["hall"]},
     {"group": "roof", "devices": ["cell-a"]}]}},
  {"building": "lighthouse", "groupList": {"queryId": "morning", "groups": []}}]}"""

TELL = """{"buildings": [
  {"building": "harbour", "cmdList": {"commands": [
     {"groupId": "ground", "devices": [{"deviceId": "hall", "command": {"name": "set", "value": 19.5}},
                                       {"deviceId": "kitchen", "command": {"name": "set", "value": 400}}]},
     {"groupId": "cellar", "devices": []}]}},
  {"building": "mill", "cmdList": {"commands": [
     {"groupId": "wheel", "devices": [{"deviceId": "cell-z", "command": {"name": "change-status", "value": "off"}},
                                      {"deviceId": "cell-y", "command": {}}]}]}}]}"""


def world(spark):
    inventory = load_device_inventory(docs_df(spark, [(1, 0, HARBOUR), (2, 0, MILL)]))
    rows = sorted(inventory.collect(), key=lambda r: (r.building, r.device_pos))
    reqs = requests_df(spark, [(50 + i, 1 + i, r.building, {"groupId": r.module, "devId": r.device_id,
                                                            "devType": r.device_type, "modulePath": r.topic})
                               for i, r in enumerate(rows)])
    return inventory, R.device_registry(reqs), R.list_groups(reqs), buildings_df(spark, ["harbour", "mill"])


def test_inventory(spark):
    inventory = world(spark)[0]
    got = {r.device_id: (r.topic, r.period_s, r.error) for r in inventory.collect()}
    assert got == {"cell-a": ("/harbour/roof/power/cell-a", 30.0, None), "hall": ("/harbour/ground/heat/hall", 2.5, None),
                   "kitchen": ("/harbour/ground/heat/kitchen", 2.5, None), "cell-z": ("/mill/wheel/power/cell-z", 60.0, None)}


def test_query_without_and_with_data(spark):
    _, reg, groups, buildings = world(spark)
    asked = E.explode_query_groups(Q.routed_queries(docs_df(spark, [(100, 60, ASK)]), buildings))
    log = log_df(spark, [(7, 20, "/harbour/ground/heat/hall",
                          {"deviceId": "hall", "value": 18.25, "unit": "Celsius", "timestamp": "2024-01-01T00:00:20"})])
    readings = delivered_readings(log, reg).where("reason IS NULL")
    res = {r.building: [(i.device, json.loads(i.json)) for i in r.results]
           for r in Q.gather_query_results(Q.query_replies(asked, readings, reg, groups), asked).collect()}
    assert set(res) == {"harbour", "mill"}                     # the lighthouse is not registered
    assert [d for d, _ in res["harbour"]] == ["kitchen", "hall", "cell-a"]
    assert [d for d, _ in res["mill"]] == ["cell-z"]
    assert res["harbour"][1][1]["value"] == 18.25
    assert [x["data"] for d, x in res["harbour"] + res["mill"] if d != "hall"] == ["NO DATA YET"] * 3
    done = {r.building: (r.expected_groups, r.received_groups, r.complete) for r in Q.gather_completeness(asked, groups).collect()}
    assert done == {"harbour": (3, 2, False), "mill": (1, 1, True)}


def test_commands(spark):
    _, reg, groups, buildings = world(spark)
    routed = C.routed_commands(docs_df(spark, [(200, 60, TELL)]), buildings)
    status = C.command_dispatch_status(routed, groups, reg)
    rows = status.collect()
    assert {r.cmd_topic for r in rows if r.ok} == {"/harbour/ground/heat/hall/cmd", "/harbour/ground/heat/kitchen/cmd",
                                                   "/mill/wheel/power/cell-z/cmd"}
    assert sorted(r.message for r in rows if not r.ok) == ["Device cell-y does not exist", "Group cellar does not exist"]
    valid = {r.device_id: (r.valid, r.set_value, r.new_status) for r in C.validate_commands(routed, groups, reg).collect()}
    assert valid["hall"] == (True, 19.5, None) and valid["cell-z"] == (True, None, "off") and not valid["kitchen"][0]
    roll = {r.building: (r.n_published, r.n_failed, r.n_missing_groups)
            for r in C.gather_command_status(C.command_rows(routed, groups, reg)).collect()}
    assert roll == {"harbour": (2, 0, 1), "mill": (1, 1, 0)}


def test_only_what_the_subscription_delivers_is_published(spark):
    """The device registers at second 10: of the earlier messages only the last
    one, which the broker retained, is published."""
    reqs = requests_df(spark, [(1, 10, "mill", {"groupId": "wheel", "devId": "axle", "devType": "thermostat",
                                                "modulePath": "/mill/wheel/heat/axle"})])
    assert [(r.status, r.reply_topic) for r in R.registration_status(reqs).collect()] == [("REGISTERED", "/mill/register/axle")]
    reading = lambda v: {"deviceId": "axle", "value": v, "unit": "Celsius", "timestamp": "t"}
    log = log_df(spark, [(i, s, "/mill/wheel/heat/axle", reading(v)) for i, s, v in
                         ((1, 2, 5.5), (2, 8, 6.5), (3, 10, 7.5), (4, 11, 8.5))])
    reg = R.device_registry(reqs)
    assert sorted(json.loads(r.json)["value"] for r in encode_telemetry(log, reg).collect()) == [7.5, 8.5]
    assert [(r.dev_id, r.value) for r in latest_per_device(log, reg).collect()] == [("axle", 8.5)]


def test_building_registration(spark):
    req = spark.createDataFrame([(1, at(1), "boathouse", "R1"), (2, at(2), "mill", "R1")],
                                "event_id LONG, ts TIMESTAMP_NTZ, building STRING, region STRING")
    out = {r.building: r.message for r in R.merge_building_registry(buildings_df(spark, ["mill"]), req).collect()}
    assert out == {"boathouse": "Building boathouse registered successfully", "mill": "Building mill is already registered"}


def test_inventory_null_period_unknown_type_and_bad_document(spark):
    doc = {"buildingId": "quay", "devices": [
        {"deviceType": "thermostat", "deviceId": "one", "module": "m", "publishingTopic": "p", "dataSendingPeriod": None},
        {"deviceType": "kettle", "deviceId": "two", "module": "m", "publishingTopic": "p", "dataSendingPeriod": 3}]}
    bad = {"buildingId": "quay", "devices": [{"deviceType": "thermostat", "deviceId": 17, "module": "m",
                                              "publishingTopic": "p", "dataSendingPeriod": 3}]}
    rows = load_device_inventory(docs_df(spark, [(1, 0, doc), (2, 0, bad)])).collect()
    assert {r.device_id: (r.period_s, r.topic, r.error) for r in rows} == {
        "one": (None, "/quay/m/p/one", None), "two": (3.0, None, "INVALID DEVICE NAME")}
