"""The registered queries: contract, plans, and results against SQL on the smallest tables."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare, duck  # noqa: E402

QUERIES, SQL = entry.queries(), entry.oracle_sql()
CHECKED = [
    "overview", "provenance", "role_demand", "city_demand", "employer_top", "employer_breadth", "band_reindexed",
    "tag_demand", "tag_pairs_all", "tag_pair_rate", "role_shift", "tag_period_shares_top", "value_distribution",
    "quartiles_by_employer", "value_by_tag", "tag_vs_rest_diff", "histogram", "kpis_filtered", "week_over_week",
    "rolling_tag_share_dense", "tag_trend_slope", "event_weekly_share", "tag_sets", "jobs_without_tag", "clean_labels", "clean_companies", "clean_experience", "clean_pay",
    "clean_calendar", "clean_tags", "table_expectations", "document_tags", "document_ranges", "fact_jobs", "job_tags",
]


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_contract(spark):
    own = {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)}  # the others are tested in tests/llm
    assert own <= set(SQL) <= set(QUERIES)
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "role_family"


@pytest.mark.parametrize("name", CHECKED)
def test_result_matches_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    assert compare(df.columns, df.dtypes, [tuple(r) for r in df.collect()], con, SQL[name]) == ""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["overview", "employer_top", "tag_pairs", "tag_demand", "kpis", "clean_labels",
                                  "rolling_tag_share_dense", "value_by_tag", "clean_tags", "role_shift"])
def test_plans_have_no_cross_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text


def test_python_only_where_names_are_folded(spark, small):
    assert "ArrowEvalPython" in plan(QUERIES["clean_companies"](spark, small))


def test_scans_are_pruned(spark, small):
    text = plan(QUERIES["role_demand"](spark, small))
    assert "ReadSchema: struct<o_orderpriority:string>" in text and "o_totalprice" not in text
    weekly = plan(QUERIES["weekly_counts"](spark, small))
    assert "o_totalprice" not in weekly and "o_orderpriority" not in weekly
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan(QUERIES["value_by_role"](spark, small))


def test_shares_add_up(spark, small):
    for name, column in [("role_audit", "share_pct"), ("mode_mix", "share_pct"), ("scope_mix", "share_pct")]:
        total = sum(r[column] for r in QUERIES[name](spark, small).collect())
        assert abs(total - 100.0) < 0.1
    rates = [r["cooccurrence_rate_pct"] for r in QUERIES["tag_pair_rate"](spark, small).collect()]
    assert all(0 <= r <= 100 for r in rates)
