"""Plan guards for the scale design: every registered query is planned and
checked for operators that would not hold at 100 TB."""

import pytest

from tablepipe.plans import catalog

SF = "/root/testdata/sf0.001"
# Nested-loop joins only where one side is bounded by something other than
# the data: one row per input, one-row relations.
BNLJ_ALLOWED = {"footer_bytes", "load_plan", "string_bytes_profile", "parquet_string_factor"}
SORT_AGG_ALLOWED = {"sql_conversations"}       # min_by over a string buffer


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in catalog.QUERIES.items():
        out[name] = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_cartesian_or_row_udfs(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BatchEvalPython" not in plan, name


def test_nested_loop_joins_only_on_bounded_sides(plans):
    bad = [n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p and n not in BNLJ_ALLOWED]
    assert bad == []


def test_sort_aggregation_only_where_expected(plans):
    bad = [n for n, p in plans.items() if "SortAggregate" in p and n not in SORT_AGG_ALLOWED]
    assert bad == []


def test_hot_key_queries_split_keys(plans):
    # the as-of and window rewrites window over split keys and join summaries
    for name in ("sql_asof", "sql_window"):
        assert "Window" in plans[name] and "SortAggregate" not in plans[name]


def test_profile_scans_each_table_once(plans):
    assert plans["size_factors"].count("FileScan parquet") == len(catalog.ALL_TABLES)
