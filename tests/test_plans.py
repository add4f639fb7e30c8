"""Plan guards: the physical plans of the batch queries contain no
cartesian or nested-loop joins, no row-at-a-time Python UDFs, and no
single-partition exchange except over tables bounded by construction."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
BATCH = [n for n in E.queries() if not n.startswith("stream_")]
# queries whose single-partition exchange runs over a bounded table:
# part_global (a daily report, the operator itself) and the per-partition
# offsets of the global running count (#partitions rows)
SINGLE_OK = {"part_global", "running_count_global"}


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plan_guards(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
    if name not in SINGLE_OK:
        assert "SinglePartition" not in plan, name


@pytest.mark.parametrize("name", ["rolling_max_by", "running_count_keyed", "jump_alarm",
                                  "running_history", "rise_alarm", "monotone_ts"])
def test_keyed_scans_split_hot_keys(spark, name):
    """Row-level shuffles of keyed scans are on (key, time bucket), never on
    the key alone."""
    plan = _plan(spark, name)
    lines = [ln for ln in plan.splitlines() if "Exchange hashpartitioning(" in ln]
    assert lines
    for ln in lines:
        part = ln.split("hashpartitioning(", 1)[1]
        assert "_tb" in part or "_streak" in part or "_n" in part or part.startswith("_k#") \
            and "_tb" not in part and _over_summary(plan, ln), ln


def _over_summary(plan, line):
    # a shuffle on the key alone is allowed only above a per-bucket aggregate
    idx = plan.index(line)
    below = plan[idx:idx + 600]
    return "Aggregate" in below


@pytest.mark.parametrize("name", ["tumbling_window_join", "interval_join", "attribute_map",
                                  "rolling_max_by", "cogroup_session"])
def test_scan_prunes_columns(spark, name):
    plan = _plan(spark, name)
    for ln in plan.splitlines():
        if "ReadSchema" in ln:
            assert "props" not in ln.split("ReadSchema")[1], f"{name} reads props"
