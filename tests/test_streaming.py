"""Streams are stopped after every slice and resumed from their checkpoint; they
equal the batch operators, also when a micro-batch fails at one of its writes
and is replayed."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from hivewire.operators import command as C
from hivewire.operators import envelopes as E
from hivewire.plans import catalog as CAT
from hivewire.sources.topic_log import idempotent_batch_writer
from hivewire.streaming import jobs
from hivewire.streaming import replay as RP
from hivewire.streaming.tables import JobTable
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("stream,batch", [
    (jobs.stream_gather, CAT.gather_idle_cutoff),
])
def test_stream_equals_batch(spark, stream, batch):
    got = stream(spark, SF_SMALL)
    want = batch(CAT.Ctx(spark, SF_SMALL))
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


class Broken(Exception):
    pass


@pytest.mark.parametrize("fail_at,after", [(2, True), (3, False), (4, True), (8, False)])
def test_registration_survives_a_failed_write(spark, monkeypatch, fail_at, after):
    """The micro-batch fails before or after its n-th write; the replayed one
    neither forgets nor repeats anything."""
    writes = [0]

    def breaking(path, topic_col=None):
        write = idempotent_batch_writer(path, topic_col)

        def go(batch, batch_id):
            writes[0] += 1
            if writes[0] == fail_at and not after:
                raise Broken
            write(batch, batch_id)
            if writes[0] == fail_at and after:
                raise Broken
        return go

    drain, failures = jobs._drain, []

    def retrying(writer):
        try:
            drain(writer)
        except StreamingQueryException as e:
            failures.append(e)
            drain(writer)

    add = JobTable.write
    def table_write(self, df, batch_id):
        writes[0] += 1
        if writes[0] == fail_at and not after:
            raise Broken
        add(self, df, batch_id)
        if writes[0] == fail_at and after:
            raise Broken

    monkeypatch.setattr(JobTable, "write", table_write)
    monkeypatch.setattr(jobs, "idempotent_batch_writer", breaking)
    monkeypatch.setattr(jobs, "_drain", retrying)
    got = rows(jobs.stream_registration(spark, SF_SMALL))
    assert len(failures) == 1
    assert got == rows(CAT.registration_status(CAT.Ctx(spark, SF_SMALL)))


def test_registration_state_store_variant_equals_batch(spark):
    got = jobs.stream_registration(spark, SF_SMALL, state="store")
    assert rows(got) == rows(CAT.registration_status(CAT.Ctx(spark, SF_SMALL)))


def test_ingest_equals_batch_with_its_own_registry(spark):
    """Devices register inside the stream; nothing is published before."""
    assert rows(jobs.stream_ingest(spark, SF_SMALL)) == rows(CAT.encode_telemetry(CAT.Ctx(spark, SF_SMALL)))


def test_a_slice_is_written_in_parallel(spark, tmp_path):
    df = spark.range(4000, numPartitions=4).selectExpr("id", "timestamp_seconds(id) AS ts")
    feed = RP.Replay(df, str(tmp_path / "in"), RP.time_bounds(df))
    assert len(list((tmp_path / "in").glob("part-*.parquet"))) >= 1
    assert len(list((tmp_path / "in-staged").glob("slice=*/part-*.parquet"))) >= 4
    n = 1
    while feed.release():
        n += 1
    assert n == RP.LEAST_SLICES and spark.read.parquet(str(tmp_path / "in")).count() == 4000


def test_answers_are_written_as_messages_per_topic(spark):
    """Every result of T6 is also a JSON message under Query-results-{building}."""
    run = jobs.Run(spark, "t6-test")
    out = {(r.event_id, r.building): r.n_items for r in jobs.stream_query_answers(spark, SF_SMALL, run).collect()}
    sent = spark.read.parquet(run.path("messages")).collect()
    assert {(r.event_id, r.building): len(json.loads(r.value)["results"]) for r in sent} == out
    assert all(r.out_topic == f"Query-results-{json.loads(r.value)['buildingId']}" for r in sent)


def test_commands_are_dispatched_under_their_topics(spark):
    run = jobs.Run(spark, "t7-test")
    jobs.stream_command_status(spark, SF_SMALL, run)
    cols = ["event_id", "building", "group_pos", "device_pos", "device_id", "cmd_topic", "cmd_payload"]
    c = CAT.Ctx(spark, SF_SMALL)
    routed = E.route_as_of(E.explode_envelope(c.commands_raw, E.COMMAND_BODY, last_wins=True, keep_text=True), c.live_buildings)
    want = C.command_dispatch_status(routed, c.groups, c.registry, c.types).where("ok").select(*cols)
    got = spark.read.parquet(run.path("dispatch")).select(*cols)
    assert rows(got) == rows(want) and got.count() > 0
    assert all(r.cmd_topic.endswith("/cmd") for r in got.collect())


def test_a_gather_emits_one_row(spark):
    got = jobs.stream_gather(spark, SF_SMALL)
    assert got.count() == got.select("user_id").distinct().count() > 0
