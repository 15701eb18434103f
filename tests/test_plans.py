"""Plan shape checks: no single-partition exchange over data-sized inputs and
column pruning at the scan, for the operators whose naive form would sort on one partition."""

import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["winsorize_lower_higher", "ntile_global", "qcut_global", "keep_latest",
                                  "drop_dup_keys", "truncate", "winsorize_by_year", "ntile_by_year"])
def test_no_single_partition(spark, name):
    """A single-partition exchange may only sit on a bounded aggregate: a global (keys=[])
    aggregate or the per-partition offset table of the distributed ranks (keys=[_pid])."""
    lines = _plan(entry_mod.queries()[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1]
            assert "HashAggregate(keys=[]" in child or "HashAggregate(keys=[_pid" in child, "\n".join(lines)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(entry_mod.queries()["drop_dup_keys"](spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "o_orderstatus" not in scan and "o_orderpriority" not in scan and "o_custkey" in scan


def test_filter_pushed_to_scan(spark):
    plan = _plan(entry_mod.queries()["user_bhar_window"](spark, SF_SMALL))
    assert any("PushedFilters" in n and "EqualTo(event_type,error)" in n for n in plan.splitlines())


def test_dropping_range_join_keeps_the_range_in_the_join(spark):
    df = entry_mod.queries()["range_join_left_drop"](spark, SF_SMALL)
    joins = [n for n in _plan(df).splitlines() if "Join" in n and "Inner" in n and "permno" in n]
    assert joins and any("namedt" in n or "_rstart" in n for n in joins)


def test_event_returns_join_not_nested_loop(spark):
    plan = _plan(entry_mod.queries()["bhar_window"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    # nested-loop joins only meet a single row: the first calendar day, the number of entities
    lines = plan.splitlines()
    sides = [i for i, line in enumerate(lines) if "BroadcastExchange IdentityBroadcastMode" in line]
    assert len(sides) == plan.count("BroadcastNestedLoopJoin")
    assert all(any("HashAggregate(keys=[]" in n for n in lines[i + 1:i + 4]) for i in sides)
