"""Physical-plan checks: broadcasts, pushdown, no Python in the hot path."""

import contextlib
import io

from tests.conftest import SF0001
from tripdemand.plans import registry


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_zone_join_is_broadcast_and_scan_is_pruned(spark):
    plan = plan_of(registry.q_trip_counts(spark, SF0001))
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_partial_aggregation_before_shuffle(spark):
    plan = plan_of(registry.q_historical_mean(spark, SF0001))
    assert "partial_count" in plan and "partial_avg" in plan


def test_every_query_is_python_free(spark):
    for name in ("parse_gps_trips", "borough_point_join", "replay_messages", "zone_lookup_join"):
        plan = plan_of(registry.QUERIES[name](spark, SF0001))
        assert "Python" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
