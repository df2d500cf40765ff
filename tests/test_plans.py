"""Plan properties that matter at scale: no cross or nested-loop joins, no window over a bare key on row-level
input, filters and columns pushed into the Parquet scan."""

import re

import pytest
from conftest import SF001
from marketframe.operators import asof, scan
from marketframe.plans import q_trading as QT
from marketframe.plans.catalog import REGISTRY
from marketframe.sources import fixtures as X


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_join(spark):
    import __spark_entry__ as E
    bad = {}
    for name, query in E.queries().items():
        p = _plan(query(spark, SF001))
        if "CartesianProduct" in p or "NestedLoopJoin" in p:
            bad[name] = p[:300]
    assert not bad, bad


@pytest.mark.parametrize("name, bounds", [
    ("price_series", ["GreaterThanOrEqual(ts,", "LessThan(ts,"]), ("serving_features", ["GreaterThanOrEqual(ts,"]),
    ("retention_ttl", ["GreaterThanOrEqual(ts,"])])
def test_time_bounds_reach_the_scan(spark, name, bounds):
    if name == "serving_features":
        import pandas as pd
        from marketframe.plans import q_features as QF
        df = QF.bars(spark, SF001, frm=pd.Timestamp(QF.SERVE_AS_OF) - pd.Timedelta(hours=QF.SERVE_LOOKBACK_H), to=QF.SERVE_AS_OF)
    else:
        df = REGISTRY[name].spark(spark, SF001)
    pushed = re.findall(r"PushedFilters: \[(.*?)\]", _plan(df))
    assert pushed and all(any(b in p for p in pushed) for b in bounds), pushed


def test_range_report_prunes_columns(spark):
    p = _plan(REGISTRY["price_series"].spark(spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in p


def test_as_of_lookup_scans_each_table_once_and_windows_over_blocks(spark):
    d, t = X.decisions(spark, SF001), QT.ticks(spark, SF001)
    p = _plan(asof.asof_join(d, t, ["symbol"], "time", "timestamp", ["price"], "seq", bounds=scan.time_bounds(t.limit(1), ["symbol"], "timestamp")))
    specs = re.findall(r"windowspecdefinition\((.*?)specifiedwindowframe", p)
    rows = [s for s in specs if "__t#" in s]
    assert rows and all("__blk#" in s.split(" ASC")[0] for s in rows)


def test_fills_read_events_at_most_three_times(spark):
    """Decisions, ticks and the two narrow columns of the bounds."""
    f = asof.asof_join_offsets(X.decisions(spark, SF001), QT.ticks(spark, SF001), ["symbol"], "time", "timestamp", ["price"], "seq", "seq",
                               {"a_": 0.0, "b_": 1.0}, bounds=X.tick_bounds(spark, SF001))
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    # the carry table is summed from the same rows: each scan appears once more, below an aggregate
    assert plan.count("Relation [event_id") <= 6


def test_bar_plans_hold_no_collected_lists(spark):
    p = _plan(REGISTRY["bars_merge_partials"].spark(spark, SF001))
    assert "collect_list" not in p and "map_from_entries" not in p


def test_feature_windows_run_over_blocks(spark):
    p = _plan(REGISTRY["features"].spark(spark, SF001))
    specs = re.findall(r"windowspecdefinition\((.*?) ASC", p)
    assert specs and all("__hb#" in s or "__blk#" in s for s in specs)
