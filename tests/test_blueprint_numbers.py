"""Counts the blueprint recorded for the sf0.01 feeds (found there with
independent scratch checks) are reproduced."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sf0.01 tables not present")


def test_gather_idle_cutoff_counts(spark):
    w4 = entry.queries()["gather_idle_cutoff"](spark, SF)
    assert w4.where("complete").count() == 28
    assert w4.where("NOT complete AND accepted > 0").count() == 79
    assert w4.where("accepted = 0").count() == 43


def test_registration_status_counts(spark):
    rows = {r.status: r["count"] for r in entry.queries()["registration_status"](spark, SF).groupBy("status").count().collect()}
    assert rows == {"DEVICE ALREADY RUNNING": 1401, "REGISTERED": 296,
                    "COULD NOT CREATE DEVICE: INVALID DEVICE NAME": 157}


def test_replay_and_query_explode_counts(spark):
    q = entry.queries()
    assert q["replay_since_registration"](spark, SF).count() == 4791
    assert q["explode_query_devices"](spark, SF).count() == 2460
