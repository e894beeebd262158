"""What the physical plans must and must not contain."""

import re

import pytest

from cohortflow.operators.locf import locf_fill
from cohortflow.plans.queries import QUERIES, _event_fill, _visits, load

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_assignment_is_one_shuffle(spark):
    df = _visits(spark, SF).timepoints
    assert shuffles(df) == 1
    match = [line for line in plan(df).splitlines() if "Filter" in line and "CASE WHEN" in line]
    assert not match, "the window match must not be inlined into a filter"


def test_fill_is_one_shuffle_for_all_columns(spark):
    assert shuffles(_event_fill(spark, SF).filled) == 1


def test_filters_and_columns_reach_the_scan(spark):
    events = load(spark, SF, "events").filter("value > 10")
    filled = locf_fill(
        events.select("user_id", "event_id", "value"),
        {"value": [[1, 40]]},
        participant_column="user_id",
        order_column="event_id",
        emit_full_grid=False,
    ).filled
    text = plan(filled)
    assert "GreaterThan(value,10.0)" in text
    assert "props" not in text


def test_split_plan_moves_no_hot_rows(spark):
    """Hot visits are joined by broadcast; only top-1 rows of a hot group are shuffled."""
    df = _visits(spark, SF, hot_rows=5, drop_unassigned=False).timepoints
    text = plan(df)
    assert "WindowGroupLimit" in text
    assert "BroadcastHashJoin" in text
    assert "CartesianProduct" not in text


@pytest.mark.parametrize(
    "name",
    [
        "timepoint_promotion", "timepoint_duplicates", "locf_full_grid", "asof_last_order", "scale_standard",
        "label_encode_customers", "outlier_iqr", "corr_pearson", "corr_spearman", "wide_all_stacked",
        "governed_customers", "range_deviation_scores", "catalog_requests", "diagonal_union",
    ],
)
def test_no_row_pairs_and_no_row_by_row_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython "):
        assert operator not in text
