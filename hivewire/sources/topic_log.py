"""Message logs as tables: read (S1), routed write (S3), committed sink (S4),
device inventory documents (S5).

A log row is (topic, msg_offset, ts, payload).  Logs are replayed from files
(parquet or JSON lines); a Kafka source only changes ``format``/options when
the connector is deployed, the downstream plan is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import json as J
from ..functions import topics as T
from ..operators.devices import DEFAULT_REGISTRY, Registry

LOG_SCHEMA = "topic STRING, msg_offset BIGINT, ts TIMESTAMP_NTZ, payload STRING"
# Text logs keep microseconds: arrival order is (ts, msg_offset).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_TEXT_OPTIONS = {"timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT}


def read_topic_log(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False,
                   schema: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Scan a message log, batch or streaming, with an explicit schema."""
    opts = _TEXT_OPTIONS if fmt in ("json", "csv") else {}
    if stream:
        r = spark.readStream.format(fmt).schema(schema or LOG_SCHEMA).options(**opts)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        return r.load(path)
    r = spark.read.format(fmt).options(**opts)
    if schema:
        r = r.schema(schema)
    return r.load(path)


def write_topic_log(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Append log rows as files a ``read_topic_log`` stream picks up."""
    opts = _TEXT_OPTIONS if fmt in ("json", "csv") else {}
    df.write.mode(mode).format(fmt).options(**opts).save(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records (topic, partition, offset, timestamp, key, value BINARY)
    -> log rows; the payload bytes are decoded as UTF-8.  Used with
    ``spark.readStream.format("kafka")`` where that connector is deployed."""
    return records.select(
        "topic", F.col("offset").cast("long").alias("msg_offset"),
        F.col("timestamp").cast("timestamp_ntz").alias("ts"),
        F.decode(F.col("value"), "UTF-8").alias("payload"),
        F.col("partition").cast("int").alias("partition"))


def read_kafka(spark: SparkSession, servers: str, topics: list[str], stream: bool = True,
               starting_offsets: str = "earliest") -> DataFrame:
    """S1 on Kafka: subscribe to an exact list of topics (S2) and map to log rows."""
    r = spark.readStream if stream else spark.read
    df = (r.format("kafka").option("kafka.bootstrap.servers", servers)
          .option("subscribe", ",".join(topics)).option("startingOffsets", starting_offsets).load())
    return from_kafka(df)


def write_routed(df: DataFrame, path: str, topic_col: str = "out_topic", mode: str = "overwrite") -> None:
    """S3: write each row under the topic it carries (one folder per topic)."""
    clustered(df, topic_col).write.mode(mode).partitionBy(topic_col).parquet(path)


def clustered(df: DataFrame, topic_col: str) -> DataFrame:
    """Rows of a topic brought together before a routed write, so a topic gets
    few files; the rebalance splits a hot topic and merges small ones by the
    sizes measured at run time."""
    return df.hint("rebalance", F.col(topic_col))


def idempotent_batch_writer(path: str, topic_col: str | None = None):
    """A ``foreachBatch`` function that (over)writes one folder per batch id.

    Structured Streaming commits the source offsets only after the batch
    function returns, and a replayed batch id rewrites the same folder, so a
    crash between write and commit cannot duplicate rows (exactly-once)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = (clustered(batch, topic_col) if topic_col else batch).write.mode("overwrite")
        if topic_col:
            w = w.partitionBy(topic_col)
        w.parquet(f"{path.rstrip('/')}/batch={batch_id}")
    return write


def load_device_inventory(docs: DataFrame, payload: str = "payload",
                          registry: Registry = DEFAULT_REGISTRY) -> DataFrame:
    """Device-list documents -> one row per device with its reading topic.

    A document must hold a string ``buildingId`` and a ``devices`` array of
    objects with string deviceType/deviceId/module/publishingTopic and a
    number dataSendingPeriod (JSON null reads as a missing number), or it is
    rejected whole.  Devices of unknown
    type keep a row with the 'INVALID DEVICE NAME' error and no topic."""
    d = docs.withColumn("_v", J.parse(F.col(payload)))
    d = d.withColumn("_devs", J.as_array(J.field(F.col("_v"), "devices")))
    strs = ("deviceType", "deviceId", "module", "publishingTopic")
    dev_ok = lambda x: (J.is_object(x) & J.is_number_or_null(J.field(x, "dataSendingPeriod"))
                        & J.is_string(J.field(x, strs[0])) & J.is_string(J.field(x, strs[1]))
                        & J.is_string(J.field(x, strs[2])) & J.is_string(J.field(x, strs[3])))
    ok = (J.is_object(F.col("_v")) & J.is_string(J.field(F.col("_v"), "buildingId"))
          & F.coalesce(F.forall("_devs", dev_ok), F.lit(False)))
    keep = [c for c in docs.columns if c != payload]
    good = d.where(ok).select(*keep, J.get_string(J.field(F.col("_v"), "buildingId")).alias("building"),
                              F.posexplode("_devs").alias("device_pos", "x"))
    out = good.select(
        *keep, "building", F.col("device_pos").cast("long").alias("device_pos"),
        J.get_string(J.field(F.col("x"), "deviceType")).alias("device_type"),
        J.get_string(J.field(F.col("x"), "deviceId")).alias("device_id"),
        J.get_string(J.field(F.col("x"), "module")).alias("module"),
        J.get_string(J.field(F.col("x"), "publishingTopic")).alias("publishing_topic"),
        J.get_double(J.field(F.col("x"), "dataSendingPeriod")).alias("period_s"))
    known = F.col("device_type").isin(*registry.names)
    return out.select("*", F.when(known, T.reading_topic(F.col("building"), F.col("module"),
                                                         F.col("publishing_topic"), F.col("device_id")))
                      .alias("topic"),
                      F.when(~known, F.lit(K.INVALID_DEVICE_NAME)).alias("error"))
