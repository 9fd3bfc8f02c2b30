"""A message is parsed once: filters on decoded columns do not copy the parse
into themselves, and jobs that read decoded messages several times keep them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hivewire.operators import decode as D
from hivewire.operators import envelopes as E
from hivewire.operators import latest as L
from hivewire.plans import catalog as CAT

T = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan()


def parses(df):
    text = plan(df).toString()
    return sum(text.count(w) for w in ("parse_json(", "parseJson(", "from_json("))


def reading(i, payload):
    return (i, T, "/b/g/telemetry/d", payload, "thermostat", "b", "g", "d")


@pytest.fixture(scope="module")
def readings(spark):
    good = '{"deviceId":"d","value":1.5,"unit":"C","timestamp":"t"}'
    rows = [reading(1, good), reading(1, good), reading(2, '{"deviceId":1}'), reading(3, None), reading(4, '{"deviceId":')]
    return spark.createDataFrame(rows, "msg_offset LONG, ts TIMESTAMP_NTZ, topic STRING, payload STRING, dev_type STRING, "
                                       "building STRING, group_id STRING, dev_id STRING").localCheckpoint()


def test_a_filter_on_the_reason_keeps_one_parse(readings):
    for df in (D.decode_by_type(readings), D.decode_thermostat(readings), D.decode_battery(readings)):
        assert parses(df.where("reason IS NULL")) == 1
        assert parses(df.where("reason IS NOT NULL")) == 1
    good, bad = D.split(D.decode_by_type(readings))
    assert [(r["msg_offset"], r["deviceId"], r["value"]) for r in good.collect()] == [(1, "d", 1.5)] * 2
    assert sorted((r["msg_offset"], r["reason"]) for r in bad.collect()) == [(2, "deviceId"), (3, "malformed"), (4, "malformed")]


def test_documents_are_parsed_once(spark):
    body = '{"queryId":"q","groups":[{"group":"g","devices":["d"]}]}'
    last = '{"queryId":"r","groups":[]}'
    docs = spark.createDataFrame([(1, T, f'{{"buildings":[{{"building":"b","groupList":{body}}},{{"building":"a","groupList":{body}}},'
                                         f'{{"building":"b","groupList":{last}}}]}}'), (2, T, "{"), (3, T, None)],
                                 "event_id LONG, ts TIMESTAMP_NTZ, payload STRING").localCheckpoint()
    groups = E.explode_query_groups(E.explode_envelope(docs, E.QUERY_BODY, last_wins=True))
    assert parses(groups) == 1
    assert sorted((r["event_id"], r["building"], r["query_id"], r["group"]) for r in groups.collect()) == [
        (1, "a", "q", "g"), (1, "b", "r", None)]


def test_published_readings_are_encoded_once(readings):
    out = L.published(D.decode_by_type(readings)).select("msg_offset", "json")
    assert plan(out).toString().count("to_json(") + plan(out).toString().count("JsonExpressionEvaluator") <= len(CAT.Registry().types)
    assert out.count() == 2


def tables_read(df):
    """Leaves of the plan that read a table and not something kept."""
    leaves = plan(df).collectLeaves()
    return [leaves.apply(i).nodeName() for i in range(leaves.size()) if "InMemoryRelation" not in leaves.apply(i).nodeName()]


SF_SMALL = "/root/testdata/sf0.001"


def test_a_plugged_in_type_reads_kept_messages(spark):
    assert tables_read(CAT.device_type_plugin(CAT.Ctx(spark, SF_SMALL))) == []


def test_replies_of_devices_are_made_of_kept_readings(spark):
    c = CAT.Ctx(spark, SF_SMALL)
    assert len(tables_read(CAT.device_replies(c, c.query_groups))) == 1         # how long a reply takes
    c.release(*CAT.REPLY_PARTS)
    assert not set(CAT.REPLY_PARTS) & set(c._memo)


def test_published_and_decoded_columns_keep_their_order(readings):
    d = D.decode_by_type(readings)
    assert d.columns == [*readings.columns, *D.READING_COLUMNS, "reason", "event_ts"]
    assert d.where(F.col("value") > 1).count() == 2
