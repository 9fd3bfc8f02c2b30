"""Log sources and sinks: JSON-lines logs, per-topic routed writes, Kafka record mapping."""

import datetime as dt

from pyspark.sql import functions as F

from hivewire.session import scratch_path
from hivewire.sources import feeds
from hivewire.sources.topic_log import LOG_SCHEMA, from_kafka, read_topic_log, write_routed, write_topic_log
from tests.conftest import SF_SMALL


def test_json_lines_log_equals_parquet_feed(spark):
    tel = feeds.load(spark, SF_SMALL, "telemetry_raw")
    path = scratch_path(spark, "jsonlog")
    write_topic_log(tel, path, fmt="json")
    back = read_topic_log(spark, path, fmt="json", schema=LOG_SCHEMA)
    cols = ["topic", "msg_offset", "ts", "payload"]
    assert sorted(back.select(*cols).collect()) == sorted(tel.select(*cols).collect())


def test_routed_write_prunes_by_topic(spark):
    tel = feeds.load(spark, SF_SMALL, "telemetry_raw").withColumn(
        "out_topic", F.concat(F.lit("Data-"), F.regexp_extract("topic", r"^/([^/]+)/", 1)))
    path = scratch_path(spark, "routed")
    write_routed(tel, path)
    one = spark.read.parquet(path).where("out_topic = 'Data-building3'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(out_topic" in plan and "Data-building3" in plan
    assert one.count() == tel.where("out_topic = 'Data-building3'").count() > 0


def test_kafka_records_map_to_log_rows(spark):
    rec = spark.createDataFrame(
        [("Data-b1", 0, 7, dt.datetime(2024, 1, 1), None, bytearray('{"a":1}', "utf-8"))],
        "topic STRING, partition INT, offset LONG, timestamp TIMESTAMP, key BINARY, value BINARY")
    row = from_kafka(rec).collect()[0]
    assert (row.topic, row.msg_offset, row.payload, row.partition) == ("Data-b1", 7, '{"a":1}', 0)
