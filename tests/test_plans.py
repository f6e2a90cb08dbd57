"""Shapes of physical plans that must not get worse."""

import re

import pytest

from __spark_entry__ import queries
from cohortspark.operators import relational

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hash_shuffles(df):
    return len(re.findall("Exchange hashpartitioning", plan_of(df)))


@pytest.mark.parametrize("name", ["context_row", "bucket_30min", "range_report", "wide_summary", "split_exact", "assemble", "item_inventory"])
def test_no_pairwise_joins(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_time_table_and_bucket_take_one_shuffle_each(spark):
    assert hash_shuffles(queries()["feature_pivot"](spark, FOLDER)) == 1
    assert hash_shuffles(queries()["bucket_30min"](spark, FOLDER)) == 2


@pytest.mark.parametrize("name", ["feature_pivot", "feature_pivot_stay", "feature_pivot_tie", "bucket_by_context"])
def test_time_tables_are_hash_aggregates(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_inventory_scans_each_table_once(spark):
    plan = plan_of(queries()["item_inventory"](spark, FOLDER))
    assert plan.count("FileScan parquet") == 2


def test_sides_are_filters(spark):
    assert "Join" not in plan_of(queries()["split_rule"](spark, FOLDER))


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    rows = spark.read.parquet(f"{FOLDER}/orders.parquet")
    plan = plan_of(relational.first_per(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["rule_clean", "unit_fix", "saps_like_score", "l2_columns", "conditional_edits", "log_band"])
def test_row_wise_operators_do_not_shuffle(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    assert "Exchange" not in plan and "Python" not in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(queries()["log_band"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan
    plan = plan_of(queries()["rows_by_label"](spark, FOLDER))
    assert "EqualTo(toxic,1)" in plan


def test_inventory_keeps_items_and_not_keys(spark):
    plan = queries()["item_inventory"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and not re.search(r"Aggregate \[l_orderkey", plan)
