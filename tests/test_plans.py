"""Plan properties of every batch query: filters and column pruning reach the
events scan, no nested-loop / cartesian joins, no Python evaluation."""

import re

import pytest

from hivewire.plans import catalog as CAT
from tests.conftest import SF_SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CAT.BATCH))
def test_plan_shape(spark, name):
    p = plan_text(CAT.BATCH[name](CAT.Ctx(spark, SF_SMALL)))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, (name, bad)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", p)
    for cols, pushed in scans:
        if "event_type" in cols:
            assert "event_type" in pushed, (name, cols, pushed)
            assert "props" not in cols, (name, "unused column read", cols)
