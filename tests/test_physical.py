"""Plans: what is pushed down, what is shuffled, and what must never appear."""

from __future__ import annotations

import pytest

from riskloom.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "t02_mann_whitney", "t11_delong_covariance", "e02_exact_auc", "w01_midrank",
    "w04_stratified_split", "a06_numeric_summary", "a08_exact_percentiles", "t06_cramers_v",
    "t18_bootstrap_replicates", "p08_rare_categories", "r02_histogram",
])
def test_no_cross_join_and_no_single_partition_of_rows(spark, name):
    plan = plan_of(spark, name)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert all("windowspecdefinition(" in w for w in windows)
    assert not any("Window [" in line and "], [" not in line for line in windows)


def test_scan_reads_only_what_is_asked(spark):
    plan = plan_of(spark, "a01_row_counts")
    assert "ReadSchema: struct<o_orderpriority:string>" in plan
    plan = plan_of(spark, "p15_membership_filter")
    assert "LessThan(c_acctbal,0.0)" in plan


def test_rank_limit_is_applied_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(spark, "w06_pick_per_class")


def test_split_assignment_moves_no_rows(spark):
    """The split itself is a broadcast comparison: no exchange between the scan and the result
    except the one that deals out a single-split test file."""
    plan = plan_of(spark, "w04_stratified_split")
    top = plan.split("BroadcastExchange")[0]
    assert "hashpartitioning" not in top


def test_profile_uses_map_side_counts(spark):
    assert "partial_count" in plan_of(spark, "a05_column_profile")


def test_oriented_lookup_computes_the_tests_once(spark):
    """Both sides of the lookup read nine stored rows, not the contributions of all rows."""
    plan = plan_of(spark, "j09_oriented_lookup").split("== Initial Plan ==")[-1]
    assert "covar_samp" not in plan and "Window [" not in plan


def test_split_values_are_found_without_a_second_ordering(spark):
    """The list of frequent scores comes from the stored points; it ordered all points once more."""
    plan = plan_of(spark, "t11_delong_covariance")
    assert plan.split("== Initial Plan ==")[-1].count("Window [") <= 4
