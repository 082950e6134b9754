"""Physical-plan properties that matter at scale."""

import re

import pytest

from pulsekit.plans import catalog
from tests.conftest import SF_MID, SF_SMALL

catalog.load_all()
QUERIES = catalog.QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.collect()            # runs this Dataset's own execution, so AQE's plan is final
    return _plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products(spark, name):
    sf = SF_MID if name.startswith(("aa_", "p_value")) else SF_SMALL
    plan = _plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["dau_7d"](spark, SF_SMALL)
    text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scan = text[text.index("Scan parquet"):]
    pushed = re.search(r"PushedFilters: \[(.*)\]", scan).group(1)
    assert "GreaterThanOrEqual(ts," in pushed and "LessThan(ts," in pushed
    assert "In(event_type, [click,view])" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert set(f.split(":")[0] for f in schema.split(",")) == {"ts", "user_id", "event_type"}


@pytest.mark.parametrize("name,scans,exchanges", [
    ("likes_7d", 1, 1), ("views_7d", 1, 1), ("ctr_7d", 1, 1),
    ("message_user_slice", 1, 2), ("message_daily", 1, 3), ("message_daily_weighted", 1, 3),
    ("dau_both", 2, 3), ("dau_feed_only", 2, 3), ("dau_message_only", 2, 3), ("feed_series_long", 3, 5),
    ("bucket_ctr_xxhash", 0, 6), ("daily_app_report", 2, 5),
    ("user_day_merged", 2, 4), ("welch_bucket", 0, 2),
])
def test_scans_and_exchanges(spark, name, scans, exchanges):
    plan = _final_plan(QUERIES[name](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == scans
    assert len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange ", plan)) <= exchanges


@pytest.mark.parametrize("name", ["dau_both", "dau_feed_only", "dau_message_only", "feed_series_long"])
def test_overlap_is_counted_without_a_join(spark, name):
    assert "Join" not in _final_plan(QUERIES[name](spark, SF_SMALL))


def test_mart_is_one_grouping_sets_aggregate(spark):
    plan = _plan(QUERIES["slice_mart"](spark, SF_SMALL))
    assert plan.count("Expand") == 1


def test_bootstrap_partially_aggregates_before_shuffle(spark):
    plan = _plan(QUERIES["poisson_bootstrap"](spark, SF_SMALL))
    # replicate rows are generated and partially summed in one stage
    assert re.search(r"HashAggregate\(keys=\[rep#\d+L?, exp_group#\d+\], functions=\[partial_sum", plan)
    # of cells, not users
    assert re.search(r"HashAggregate\(keys=\[exp_group#\d+, likes#\d+L?, views#\d+L?\], functions=\[partial_count", plan)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_tasks(spark, name):
    sf = SF_MID if name.startswith(("aa_", "p_value")) else SF_SMALL
    plan = _plan(QUERIES[name](spark, sf))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
