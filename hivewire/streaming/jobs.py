"""Structured Streaming jobs.

Every job reads a feed as a file stream (Kafka is a change of ``format``),
uses the same operators as the batch jobs, and writes through an idempotent
per-batch sink with a checkpoint, so a restarted query neither loses nor
duplicates output.  Registered queries replay the feed with
``trigger(availableNow=True)`` in several micro-batches and read the sink
back; they must equal the batch results.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..operators import command as C
from ..operators import decode as D
from ..operators import envelopes as E
from ..operators import latest as L
from ..operators import nested as N
from ..operators import query as Q
from ..operators import registry as R
from ..operators.registry import DEVICE_KEY
from ..operators.fold import expected_columns
from ..plans import catalog as CAT
from ..session import scratch_path
from ..sources import feeds
from ..sources.topic_log import idempotent_batch_writer
from . import replay as RP
from . import stateful as ST
from .gather import Gathers
from .tables import JobTable
from .timers import Attempts, NestedGathers


class Run:
    """Scratch folders of one replay: feed files, checkpoints, sinks."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"stream-{name}")
        self.feed: RP.Replay | None = None

    def path(self, what: str) -> str:
        return f"{self.base}/{what}"


def _replay(run: Run, name: str, df: DataFrame, bounds) -> DataFrame:
    """Cut ``df`` into time slices and open them as a stream."""
    run.feed = RP.Replay(df, run.path(f"in-{name}"), bounds)
    return run.feed.stream()


def _bounds(c: CAT.Ctx):
    return RP.time_bounds(c.spark.read.parquet(f"{c.sf.rstrip('/')}/events.parquet"))


def _drain(writer) -> None:
    """Process all that has arrived, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def _run_batches(stream: DataFrame, run: Run, fn, name: str = "sink", mode: str = "append") -> None:
    """Drain the stream through ``fn``, slice by slice.  Between slices the query
    is stopped and resumed from its checkpoint, so every run also exercises
    the restart; an error in ``fn`` fails the micro-batch, which the next start
    replays under the same batch id."""
    while True:
        _drain(stream.writeStream.foreachBatch(fn).outputMode(mode).option("checkpointLocation", run.path(f"ckpt-{name}")))
        if not run.feed.release():
            break


def _read_sink(run: Run, name: str = "out") -> DataFrame:
    return run.spark.read.parquet(run.path(name)).drop("batch")


# --- S4 / T1 ----------------------------------------------------------------

def committed_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log -> idempotent per-batch files; the query is stopped after every
    slice and resumed from its checkpoint, then read back."""
    c = CAT.Ctx(spark, sf_dir)
    run = Run(spark, "s4")
    src = _replay(run, "telemetry", c.telemetry, _bounds(c))
    _run_batches(src, run, idempotent_batch_writer(run.path("out")))
    return _read_sink(run).select("msg_offset", "ts", "topic", "payload")


_REGISTRY = ("building STRING, group_id STRING, dev_id STRING, dev_type STRING, module_path STRING, "
             "reg_ts TIMESTAMP_NTZ, reg_event_id LONG")
_GROUPS = "building STRING, group_id STRING, created_ts TIMESTAMP_NTZ"
_RETAINED = "msg_offset LONG, ts TIMESTAMP_NTZ, topic STRING, payload STRING"
READING, REQUEST, QUERY, COMMAND, BUILDING, REPLY = "reading", "request", "query", "command", "building", "reply"


def _log(**feeds_of: DataFrame) -> DataFrame:
    """One message log of several feeds: ``kind`` (the argument's name), id,
    time, topic, building and payload."""
    log = None
    for kind, df in feeds_of.items():
        has = lambda name: F.col(name) if name in df.columns else F.lit(None).cast("string")
        part = df.select(F.lit(kind).alias("kind"), F.col("msg_offset" if kind == READING else "event_id").alias("id"),
                         "ts", has("topic").alias("topic"), has("building").alias("building"),
                         has("region").alias("region"), has("payload").alias("payload"))
        log = part if log is None else log.unionByName(part)
    return log


class Fleet:
    """What a job knows of the devices, kept in tables (``JobTable``) that its own
    micro-batches advance: registry and groups (a batch adds the new ones), the
    last message of every topic (what a broker retains) and the last valid
    delivered reading of every device (a batch writes those it has seen).

    ``see`` reads a micro-batch against what earlier batches left; ``additions``
    are the batch's, written after the job's outputs, so a replayed batch starts
    from the same state."""

    def __init__(self, run: Run, types, readings: bool = True, latest: bool = False):
        self.types, self.readings, self.keeps_latest = types, readings, latest
        self._kept: list[DataFrame] = []
        self.known_devices = JobTable(run.spark, run.path("registry"), _REGISTRY, DEVICE_KEY)
        self.known_groups = JobTable(run.spark, run.path("groups"), _GROUPS, ["building", "group_id"])
        if readings:
            self.retained = JobTable(run.spark, run.path("retained"), _RETAINED, ["topic"], ["ts", "msg_offset"])
        if latest:
            schema = ("building STRING, group_id STRING, dev_id STRING, dev_type STRING, msg_offset LONG, "
                      "ts TIMESTAMP_NTZ, " + D.reading_schema(types))
            self.latest = JobTable(run.spark, run.path("latest"), schema, DEVICE_KEY, ["ts", "msg_offset"])

    def see(self, batch: DataFrame, batch_id: int) -> None:
        """Registry and groups with this batch's registrations; ``delivered``:
        what subscriptions deliver in this batch (J3), decoded, bad rows with
        their reason.  A device that registers in the batch receives the
        retained message and every later one, others every reading."""
        requests = batch.where(F.col("kind") == REQUEST).select(F.col("id").alias("event_id"), "ts", "building", "topic", "payload")
        decoded = self.keep(R.decoded_requests(requests))
        known = self.keep(self.known_devices.before(batch_id))
        self.fresh = self.keep(R.registry_of(decoded, self.types).join(known, DEVICE_KEY, "left_anti"))
        self.registry = known.unionByName(self.fresh)
        had = self.keep(self.known_groups.before(batch_id))
        self.new_groups = R.groups_of(decoded).join(had, ["building", "group_id"], "left_anti")
        self.groups = had.unionByName(self.new_groups)
        if not self.readings:
            return
        self.messages = batch.where(F.col("kind") == READING).select(F.col("id").alias("msg_offset"), "ts", "topic", "payload")
        log = self.retained.before(batch_id).unionByName(self.messages)
        delivered = L.replay_since_registration(log, self.fresh).unionByName(
            L.telemetry_of_registered(self.messages, known).withColumn("retained", F.lit(False)))
        self.delivered = self.keep(D.decode_by_type(delivered, registry=self.types))
        if self.keeps_latest:
            cols = [*DEVICE_KEY, "dev_type", "msg_offset", "ts", *D.reading_columns(self.types)]
            self.valid = self.delivered.where("reason IS NULL").select(*cols)
            # a value as of a time in this batch is the last one before it or one of its own
            self.values = self.latest.before(batch_id).select(*cols).unionByName(self.valid)

    def additions(self) -> list[tuple[JobTable, DataFrame]]:
        out = [(self.known_devices, self.fresh), (self.known_groups, self.new_groups)]
        if self.readings:
            out.append((self.retained, L.retained_snapshot(self.messages)))
        if self.keeps_latest:
            out.append((self.latest, L.latest_of(self.valid, self.types)))
        return out

    def release(self) -> None:
        """Let go of what ``see`` keeps in memory, also when the batch failed."""
        while self._kept:
            self._kept.pop().unpersist()

    def keep(self, df: DataFrame) -> DataFrame:
        self._kept.append(df.persist())
        return self._kept[-1]


class Buildings:
    """The buildings that exist, each since an instant: those of the start, and
    every other one since its first registration request in the stream (U2)."""

    def __init__(self, run: Run, seed: DataFrame):
        self.seed = seed
        self.added = JobTable(run.spark, run.path("buildings"), "building STRING, since TIMESTAMP_NTZ", ["building"])

    def see(self, batch: DataFrame, batch_id: int) -> None:
        known = R.building_instants(self.seed).unionByName(self.added.before(batch_id))
        asked = batch.where(F.col("kind") == BUILDING).groupBy("building").agg(F.min("ts").alias("since"))
        self.fresh = asked.join(known, "building", "left_anti")
        self.instants = known.unionByName(self.fresh)

    def additions(self) -> list[tuple[JobTable, DataFrame]]:
        return [(self.added, self.fresh)]

    def release(self) -> None:
        pass


class Regions:
    """The regions' buildings, each in its region since an instant: the start, or the
    first registration request there (U2).  A region's view follows the topics of
    its buildings, so its set of sources grows between micro-batches."""

    KEY = ["region", "building"]

    def __init__(self, run: Run, seed: DataFrame):
        self.seed = seed.select(*self.KEY, F.lit(R.START).cast("timestamp_ntz").alias("since")).distinct()
        self.added = JobTable(run.spark, run.path("regions"), "region STRING, building STRING, since TIMESTAMP_NTZ", self.KEY)

    def see(self, batch: DataFrame, batch_id: int) -> None:
        known = self.seed.unionByName(self.added.before(batch_id))
        asked = batch.where(F.col("kind") == BUILDING).groupBy(*self.KEY).agg(F.min("ts").alias("since"))
        self.fresh = asked.join(known, self.KEY, "left_anti")
        self.instants = known.unionByName(self.fresh)

    def of(self, messages: DataFrame) -> DataFrame:
        """``messages(building, at, ...)`` once for every region that has the building by then."""
        return messages.join(self.instants, "building").where(F.col("since") <= F.col("at")).drop("since", "at")

    def additions(self) -> list[tuple[JobTable, DataFrame]]:
        return [(self.added, self.fresh)]

    def release(self) -> None:
        pass


def _run_stateful(src: DataFrame, run: Run, states: list, job: Callable[[DataFrame, int], list | None]) -> None:
    """Every micro-batch: ``states`` see it, ``job`` writes the outputs (and may give
    rows for tables of its own), then all additions are written side by side.
    Any failure fails the batch; its replay ignores what it left."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for x in states:
                x.see(batch, batch_id)
            writes = job(batch, batch_id) or []
            writes += [w for x in states for w in x.additions()]
            if writes:
                with ThreadPoolExecutor(len(writes)) as pool:
                    list(pool.map(lambda w: w[0].write(w[1], batch_id, *w[2:]), writes))
        finally:
            for x in states:
                x.release()
            batch.unpersist()

    _run_batches(src, run, sink)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log of registration requests and readings -> strict decode ->
    what the subscriptions deliver as canonical JSON on Data-{building}, the
    rest to a quarantine folder.  The job keeps its own registry and the
    retained messages (``Fleet``)."""
    c = CAT.Ctx(spark, sf_dir)
    run = Run(spark, "t1")
    src = _replay(run, "log", _log(reading=c.telemetry, request=c.requests), _bounds(c))
    fleet = Fleet(run, c.types)
    valid_w = idempotent_batch_writer(run.path("out"))
    bad_w = idempotent_batch_writer(run.path("quarantine"))

    def job(batch: DataFrame, batch_id: int) -> None:
        valid_w(L.published(fleet.delivered, c.types).select("msg_offset", "building", "group_id", "dev_id", "out_topic", "json"),
                batch_id)
        bad_w(fleet.delivered.where("reason IS NOT NULL").select("msg_offset", "topic", "building", "group_id", "dev_id",
                                                                 "dev_type", "reason"), batch_id)

    _run_stateful(src, run, [fleet], job)
    return _read_sink(run)


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuously updated latest value per device, devices registering
    inside the stream.  Every micro-batch adds the latest of its valid delivered
    readings to the table of latest values (``Fleet``), which is the result."""
    c = CAT.Ctx(spark, sf_dir)
    run = Run(spark, "t3")
    src = _replay(run, "log", _log(reading=c.telemetry, request=c.requests), _bounds(c))
    fleet = Fleet(run, c.types, latest=True)
    _run_stateful(src, run, [fleet], lambda batch, batch_id: None)
    return fleet.latest.current().select(*DEVICE_KEY, "dev_type", "msg_offset", "ts", "value", "unit", "percentage", "status")


# --- T4 / T6 / T7: region documents ---------------------------------------------------

def _documents(batch: DataFrame, kind: str) -> DataFrame:
    return batch.where(F.col("kind") == kind).select(F.col("id").alias("event_id"), "ts", "payload")


def _decoded(docs: DataFrame, body: str, buildings: DataFrame, keep_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(persisted decoded documents, their entries routed to the buildings that exist
    at the documents' time); documents that do not decode are in the first for
    the quarantine."""
    decoded = E.decode_envelope(docs, body).persist()
    entries = E.explode_decoded(decoded, body, last_wins=True, keep_text=keep_text)
    return decoded, E.route_as_of(entries, buildings)


def stream_route_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: region query and command documents -> per-building topics (one folder
    per topic), buildings registering inside the stream; documents that do not
    decode go to a quarantine folder."""
    c = CAT.Ctx(spark, sf_dir)
    run = Run(spark, "t4")
    src = _replay(run, "documents", _log(query=c.queries_raw, command=c.commands_raw, building=c.building_requests), _bounds(c))
    buildings = Buildings(run, c.buildings)
    routed_w = idempotent_batch_writer(run.path("out"), topic_col="out_topic")
    bad_w = idempotent_batch_writer(run.path("quarantine"))

    def job(batch: DataFrame, batch_id: int) -> None:
        queries, routed_q = _decoded(_documents(batch, QUERY), E.QUERY_BODY, buildings.instants)
        commands, routed_c = _decoded(_documents(batch, COMMAND), E.COMMAND_BODY, buildings.instants)
        routed_w(CAT.to_topics(routed_q, K.QUERY_PREFIX).unionByName(CAT.to_topics(routed_c, K.COMMAND_PREFIX)), batch_id)
        bad_w(E.envelope_quarantine(queries).unionByName(E.envelope_quarantine(commands)), batch_id)
        for df in (queries, commands):
            df.unpersist()

    _run_stateful(src, run, [buildings], job)
    return CAT.bodies_of(_read_sink(run))


def stream_query_answers(spark: SparkSession, sf_dir: str, run: Run | None = None) -> DataFrame:
    """One log of building and device registrations, readings and query
    documents; every query to a building that exists by then is answered with the latest values as of its time, from what the stream
    has seen (``Fleet``), as JSON under Query-results-{building} in
    ``messages``; bad documents go to a quarantine folder."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "t6")
    src = _replay(run, "log", _log(reading=c.telemetry, request=c.requests, query=c.queries_raw, building=c.building_requests),
                  _bounds(c))
    buildings = Buildings(run, c.buildings)
    fleet = Fleet(run, c.types, latest=True)
    out_w = idempotent_batch_writer(run.path("out"))
    message_w = idempotent_batch_writer(run.path("messages"), topic_col="out_topic")
    bad_w = idempotent_batch_writer(run.path("quarantine"))

    def job(batch: DataFrame, batch_id: int) -> None:
        decoded, routed = _decoded(_documents(batch, QUERY), E.QUERY_BODY, buildings.instants)
        groups = E.explode_query_groups(routed).persist()
        known = fleet.keep(Q.query_known_devices(E.devices_of_groups(groups), fleet.registry))
        asked = known.select("building", F.col("group").alias("group_id"), F.col("device").alias("dev_id")).distinct()
        values = fleet.keep(fleet.values.join(asked, DEVICE_KEY, "left_semi"))      # the carry of J6 reads them twice
        replies = Q.query_replies(groups, values, fleet.registry, fleet.groups, c.types, known=known).persist()
        out_w(CAT.results_text(replies, groups), batch_id)
        message_w(Q.query_results_json(Q.gather_query_results(replies, groups)), batch_id)
        bad_w(E.envelope_quarantine(decoded), batch_id)
        for df in (replies, groups, decoded):
            df.unpersist()

    _run_stateful(src, run, [fleet, buildings], job)
    return _read_sink(run)


def stream_command_status(spark: SparkSession, sf_dir: str, run: Run | None = None) -> DataFrame:
    """One log of building and device registrations and command documents;
    commands for known devices are dispatched on ``{path}/cmd`` (folder ``dispatch``), every
    document gets its status roll-up, bad ones go to a quarantine folder."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "t7")
    src = _replay(run, "log", _log(request=c.requests, command=c.commands_raw, building=c.building_requests), _bounds(c))
    buildings = Buildings(run, c.buildings)
    fleet = Fleet(run, c.types, readings=False)
    out_w = idempotent_batch_writer(run.path("out"))
    dispatch_w = idempotent_batch_writer(run.path("dispatch"))
    bad_w = idempotent_batch_writer(run.path("quarantine"))

    def job(batch: DataFrame, batch_id: int) -> None:
        decoded, routed = _decoded(_documents(batch, COMMAND), E.COMMAND_BODY, buildings.instants, keep_text=True)
        rows = C.command_rows(routed, fleet.groups, fleet.registry, c.types).persist()
        out_w(C.gather_command_status(rows), batch_id)
        dispatch_w(C.dispatch_statuses(rows).where("ok").select("event_id", "building", "group_pos", "device_pos", "device_id",
                                                                "cmd_topic", "cmd_payload"), batch_id)
        bad_w(E.envelope_quarantine(decoded), batch_id)
        for df in (rows, decoded):
            df.unpersist()

    _run_stateful(src, run, [fleet, buildings], job)
    return _read_sink(run)


def stream_region_view(spark: SparkSession, sf_dir: str, run: Run | None = None) -> DataFrame:
    """U1 live: what each region sees of its buildings' topics, Data-{building} and
    Query-results-{building}.  A building that registers inside the stream is
    followed from then on, next to those followed already; readings count at
    their arrival, the retained one at the device's registration."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "u1")
    src = _replay(run, "log", _log(reading=c.telemetry, request=c.requests, query=c.queries_raw, building=c.building_requests),
                  _bounds(c))
    fleet, regions = Fleet(run, c.types), Regions(run, c.buildings)
    out_w = idempotent_batch_writer(run.path("out"))

    def job(batch: DataFrame, batch_id: int) -> None:
        decoded, routed = _decoded(_documents(batch, QUERY), E.QUERY_BODY, regions.instants)
        answered = Q.query_keys(E.explode_query_groups(routed), "ts")
        data = L.published(fleet.delivered, c.types).select(
            "building", "out_topic", F.lit("data").alias("kind"), F.col("msg_offset").alias("key"), F.greatest("ts", "reg_ts").alias("at"))
        results = answered.select("building", F.concat(F.lit(K.QUERY_RESULTS_PREFIX + "-"), "building").alias("out_topic"),
                                  F.lit("query-results").alias("kind"), F.col("event_id").alias("key"), F.col("ts").alias("at"))
        out_w(regions.of(data.unionByName(results)).select("region", "building", "out_topic", "kind", "key"), batch_id)
        decoded.unpersist()

    _run_stateful(src, run, [fleet, regions], job)
    return _read_sink(run)


# --- T2 / T5 / T8: custom state -------------------------------------------------

def registration_batch(batch: DataFrame, registry_so_far: DataFrame, types) -> tuple[DataFrame, DataFrame]:
    """One micro-batch of decoded requests against the registry written by
    earlier batches: (reply rows, newly registered devices).  Within the batch
    the batch operator W1 applies; a device registered earlier is already
    running."""
    new = R.registry_of(batch, types)
    known = registry_so_far.select(*DEVICE_KEY).distinct().withColumn("_known", F.lit(True))
    st = R.statuses_of(batch, types, new).join(known, DEVICE_KEY, "left")
    st = st.withColumn("status", F.when(F.col("_known"), F.lit(K.ALREADY_RUNNING)).otherwise(F.col("status")))
    fresh = new.join(known, DEVICE_KEY, "left_anti")
    return st.drop("_known"), fresh


def stream_registration(spark: SparkSession, sf_dir: str, state: str = "table") -> DataFrame:
    """Registration requests -> one reply per request; requests that do not
    decode go to a quarantine folder.

    ``state="table"`` (default) keeps the registry as a ``JobTable`` next to the
    checkpoint: each micro-batch is answered with the batch operator (JVM only, no per-key Python) against the devices
    registered by earlier batches.  ``state="store"`` keeps a flag per device
    in the RocksDB state store (``transformWithStateInPandas``)."""
    c = CAT.Ctx(spark, sf_dir)
    run = Run(spark, "t2")
    out_w = idempotent_batch_writer(run.path("out"))
    if state == "store":
        src = _replay(run, "requests", D.split(D.decode_register(c.requests))[0], _bounds(c))
        _run_batches(ST.registration_replies(src, c.types), run, out_w)
    else:
        src = _replay(run, "requests", c.requests, _bounds(c))
        registry = JobTable(spark, run.path("registry"), "building STRING, group_id STRING, dev_id STRING", DEVICE_KEY)
        bad_w = idempotent_batch_writer(run.path("quarantine"))

        def sink(batch: DataFrame, batch_id: int) -> None:
            good, bad = (df.persist() for df in D.split(D.decode_register(batch)))
            replies, fresh = registration_batch(good, registry.before(batch_id), c.types)
            out_w(replies, batch_id)
            bad_w(bad, batch_id)
            registry.write(fresh.select(*DEVICE_KEY), batch_id)
            good.unpersist()
            bad.unpersist()

        _run_batches(src, run, sink)
    return _read_sink(run).select("event_id", "building", "group_id", "dev_id", "reply_topic", "status")


def stream_gather(spark: SparkSession, sf_dir: str, state: str = "table", run: Run | None = None) -> DataFrame:
    """T5: request/reply gather with an idle timeout; every request gets one result
    row, at the expected count or at the timeout; late rows go to a quarantine.

    ``state="table"`` (default) folds every micro-batch with joins and windows from
    the open gathers (``Gathers``, JVM only); ``state="store"`` keeps a gather per
    key in the RocksDB state store with event-time timers.  A tick behind the last
    event (later than timeout and lateness) tells the stream that time has
    passed, so the last gathers time out as well."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "t5")
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").where(
        "event_type IN ('purchase', 'view')").select("user_id", "event_id", "ts", "event_type")
    timeout = feeds.GATHER_TIMEOUT_HOURS * 3600
    late = F.make_dt_interval(secs=F.lit(2 * (timeout + ST.LATENESS_SECONDS)))
    tick = ev.agg((F.max("ts") + late).alias("ts"), F.max("user_id").alias("user_id")).where("ts IS NOT NULL").withColumn("event_type", F.lit("tick"))
    src = _replay(run, "events", ev.unionByName(tick, allowMissingColumns=True), _bounds(c))
    out_w = idempotent_batch_writer(run.path("out"))
    if state == "store":
        _run_batches(ST.idle_gather(src, feeds.GATHER_EXPECTED, timeout), run, out_w)
        return _read_sink(run)
    late_w = idempotent_batch_writer(run.path("quarantine"))
    gathers = Gathers(spark, run.path("state"), feeds.GATHER_EXPECTED, timeout)

    def job(batch: DataFrame, batch_id: int) -> list:
        done, behind, writes = gathers.fold(batch, batch_id)
        out_w(done, batch_id)
        late_w(behind, batch_id)
        return writes

    _run_stateful(src, run, [], job)
    return _read_sink(run)


def stream_device_state(spark: SparkSession, sf_dir: str, run: Run | None = None) -> DataFrame:
    """One log of building and device registrations, readings and command
    documents, folded into the devices' expected state, one output row per event.
    A device runs from its registration on.

    A micro-batch is folded by the batch operator (``expected_states``) from the
    states that earlier ones left, so a hot device is folded in as many parts as
    it has time buckets and no row passes Python; the last state of every device
    it has touched is added to the table of states.  Within a micro-batch events
    are in time order, across micro-batches in arrival order."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "t8")
    src = _replay(run, "log", _log(reading=c.telemetry, request=c.requests, command=c.commands_raw, building=c.building_requests),
                  _bounds(c))
    fleet, buildings = Fleet(run, c.types, readings=False), Buildings(run, c.buildings)
    columns = expected_columns(c.types)
    states = JobTable(spark, run.path("states"), "building STRING, group_id STRING, dev_id STRING, dev_type STRING, " + ", ".join(
        f"{x} {C.STATE_KINDS.get(x, 'double')}" for x in columns), DEVICE_KEY, order=[])
    out_w = idempotent_batch_writer(run.path("out"))

    def job(batch: DataFrame, batch_id: int) -> list:
        readings = batch.where(F.col("kind") == READING).select(F.col("id").alias("msg_offset"), "ts", "topic", "payload")
        valid = L.valid_readings(readings, fleet.registry, c.types).where("ts > reg_ts")
        decoded, routed = _decoded(_documents(batch, COMMAND), E.COMMAND_BODY, buildings.instants, keep_text=True)
        events = C.device_events(valid, C.validate_commands(routed, fleet.groups, fleet.registry, c.types), c.types).persist()
        first = events.agg(F.min("ts").alias("t")).first()["t"]     # one value: before it all earlier states stand
        touched = events.select(*DEVICE_KEY).distinct()
        before = states.before(batch_id).join(touched, DEVICE_KEY, "left_semi").withColumn("ts", F.lit(first).cast("timestamp_ntz"))
        out = fleet.keep(C.expected_states(events, c.types, before))
        out_w(out, batch_id)
        for df in (events, decoded):
            df.unpersist()
        last = F.max_by(F.struct(*columns), F.struct("ts", F.col("kind") == "command", "seq"))
        return [(states, out.groupBy(*DEVICE_KEY, "dev_type").agg(last.alias("s")).select(*DEVICE_KEY, "dev_type", "s.*"))]

    _run_stateful(src, run, [fleet, buildings], job)
    return _read_sink(run).drop("ts")


def _tick(df: DataFrame, seconds: float = 24 * 3600) -> DataFrame:
    """A row behind the last of ``df``: time has passed, timers that are set fire."""
    late = F.make_dt_interval(secs=F.lit(float(seconds)))
    return df.agg((F.max("ts") + late).alias("ts")).where("ts IS NOT NULL").withColumn("event_id", F.lit(None).cast("long"))


_REPLY_BODY = "query_id STRING, group_pos LONG, device_pos LONG, text STRING"


def stream_two_level_gather(spark: SparkSession, sf_dir: str, run: Run | None = None) -> DataFrame:
    """A4/A5 live: query documents are routed to the buildings that exist by then, groups and
    buildings gather the devices' replies with timers of their own, and
    every query is answered once, completely or with what came in time.  Replies
    without an open query and documents that do not decode go to quarantine folders."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "a4")
    routed = E.route_as_of(E.explode_envelope(c.queries_raw, E.QUERY_BODY, last_wins=True), c.live_buildings)
    replies = CAT.device_replies(c, E.explode_query_groups(routed)).withColumn(
        "payload", F.to_json(F.struct("query_id", "group_pos", "device_pos", "text"))).persist()      # the log and its tick
    src = _replay(run, "log", _log(request=c.requests, query=c.queries_raw, building=c.building_requests, reply=replies,
                                   tick=_tick(replies.select("ts").unionByName(c.queries_raw.select("ts")))), _bounds(c))
    replies.unpersist()
    c.release(*CAT.REPLY_PARTS)
    fleet, buildings = Fleet(run, c.types, readings=False), Buildings(run, c.buildings)
    gathers = NestedGathers(spark, run.path("gathers"))
    out_w = idempotent_batch_writer(run.path("out"))
    stray_w = idempotent_batch_writer(run.path("strays"))
    bad_w = idempotent_batch_writer(run.path("quarantine"))

    def job(batch: DataFrame, batch_id: int) -> list:
        decoded, routed = _decoded(_documents(batch, QUERY), E.QUERY_BODY, buildings.instants)
        asked = N.asked_groups(E.explode_query_groups(routed), fleet.registry, fleet.groups)
        came = batch.where(F.col("kind") == REPLY).select(F.col("id").alias("event_id"), "ts", "building",
                                                          F.from_json("payload", _REPLY_BODY).alias("r")).select("*", "r.*")
        done, strays, writes = gathers.fold(batch, asked, came, batch_id, fleet.keep)
        out_w(done, batch_id)
        stray_w(strays, batch_id)
        bad_w(E.envelope_quarantine(decoded), batch_id)
        decoded.unpersist()
        return writes

    _run_stateful(src, run, [fleet, buildings], job)
    return _read_sink(run)


def stream_device_attempts(spark: SparkSession, sf_dir: str, run: Run | None = None) -> DataFrame:
    """W5 live: devices ask to be registered until a reply tells them that they run.
    Requests without a reply by their deadline time out; transitions
    (running, rejected, timed out) are written as they happen, the table of
    devices is the result."""
    c = CAT.Ctx(spark, sf_dir)
    run = run or Run(spark, "w5")
    sent, replies = c.feed("edge_requests"), CAT.registration_replies(c)
    log = lambda df, kind, status: df.select(F.lit(kind).alias("kind"), "event_id", "ts", "building", "dev_id", status.alias("status"))     # noqa: E731
    none = F.lit(None).cast("string")
    tick = _tick(sent.select("ts").unionByName(replies.select("ts"))).withColumns({"building": none, "dev_id": none})
    messages = log(sent, "request", none).unionByName(log(replies, "reply", F.col("status"))).unionByName(log(tick, "tick", none))
    src = _replay(run, "log", messages, _bounds(c))
    attempts = Attempts(spark, run.path("attempts"), feeds.REGISTER_TIMEOUT_SECONDS)
    out_w = idempotent_batch_writer(run.path("transitions"))
    late_w = idempotent_batch_writer(run.path("quarantine"))
    kept: list[DataFrame] = []

    class Kept:
        see = staticmethod(lambda batch, batch_id: None)
        additions = staticmethod(list)

        @staticmethod
        def release() -> None:
            while kept:
                kept.pop().unpersist()

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist())
        return kept[-1]

    def job(batch: DataFrame, batch_id: int) -> list:
        transitions, late, writes = attempts.fold(batch, batch.where("kind <> 'tick'"), batch_id, keep)
        out_w(transitions, batch_id)
        late_w(late, batch_id)
        return writes

    _run_stateful(src, run, [Kept], job)
    return attempts.current()


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "committed_sink": committed_sink,
    "stream_ingest": stream_ingest,
    "stream_registration": stream_registration,
    "stream_latest": stream_latest,
    "stream_route_envelopes": stream_route_envelopes,
    "stream_gather": stream_gather,
    "stream_query_answers": stream_query_answers,
    "stream_command_status": stream_command_status,
    "stream_device_state": stream_device_state,
    "stream_region_view": stream_region_view,
    "stream_two_level_gather": stream_two_level_gather,
    "stream_device_attempts": stream_device_attempts,
}


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(STREAMS)
