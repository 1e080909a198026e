"""Plan-shape checks: the properties the scale design relies on."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_flagship_one_aggregate_shuffle_and_single_parse(spark):
    df = E.queries()["bucket_labels"](spark, SF_SMALL)
    plan = executed(df)
    # one hash shuffle for the roll-up (+ the range shuffle of the final sort
    # and the spread of the single-split scan)
    assert plan.count("hashpartitioning(LogName") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the time token is extracted once per line (filters are not inlined)
    assert optimized(df).count("regexp_extract") == 1
    # only the needed columns are read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


@pytest.mark.parametrize("key", ["freq_relative", "event_windows", "freq_of_freq", "empty_events"])
def test_no_pairwise_joins(spark, key):
    plan = executed(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_word_scan_is_pruned(spark):
    plan = executed(E.queries()["freqdist"](spark, SF_SMALL))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
