"""Plan properties the scale design relies on (checked on sf0.001 plans)."""

import re

import pytest

from loanlens.plans.queries import SQL_QUERIES

SMALL = "/root/testdata/sf0.001"


def plan_text(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(SQL_QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = plan_text(spark, SQL_QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["top_segments", "page_cuts"])
def test_top_k_windows_limit_per_task(spark, name):
    plan = plan_text(spark, SQL_QUERIES[name](spark, SMALL))
    assert "WindowGroupLimit" in plan


def test_entry_query_reads_only_what_it_needs(spark):
    """The registered entry query: pruned columns, no lineitem, the level filter on the scan."""
    plan = plan_text(spark, SQL_QUERIES["default_rate_by_level"](spark, SMALL))
    orders_schema = re.search(r"orders\.parquet\].*?ReadSchema: (struct<[^>]*>)", plan, re.S).group(1)
    assert "o_orderstatus" not in orders_schema and "o_orderkey" in orders_schema
    assert "UG" in plan.split("(2) Filter")[1].split("(3)")[0]
    assert "lineitem" not in plan   # the unused line count is pruned away entirely


@pytest.mark.parametrize("name", sorted(SQL_QUERIES))
def test_no_registered_query_is_cached(spark, name):
    assert "InMemoryTableScan" not in plan_text(spark, SQL_QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", ["numeric_distribution", "fold_medians", "fold_categories", "rank_auc_by_level"])
def test_ranks_come_from_stored_ranges(spark, name):
    """A range partitioning that is computed twice may draw other bounds: rows and totals must read one stored table."""
    plan = plan_text(spark, SQL_QUERIES[name](spark, SMALL))
    assert "ExistingRDD" in plan and "rangepartitioning" not in plan.lower()


@pytest.mark.parametrize("name", ["class_balance", "segment_rates", "segment_fallback", "stratified_folds", "correlation_with_default"])
def test_building_a_query_starts_no_job(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", "building only")
    SQL_QUERIES[name](spark, SMALL)
    assert list(sc.statusTracker().getJobIdsForGroup(f"build-{name}")) == []
    sc.setLocalProperty("spark.jobGroup.id", None)
