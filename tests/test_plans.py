"""The plans hold the shapes the operators promise."""

import pytest
from pyspark.sql import functions as F

from shelfline.catalog import QUERIES, runnable
from shelfline.operators import joins, windows
from shelfline.views import keyword_traffic

# training runs and streams act when they are called; their plans are trivial reads
SKIP = {"train_classifier", "score_table", "feature_importance", "master_incremental"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_product_of_two_tables(spark, folder, name):
    text = plan(runnable()[name](spark, folder))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_top_n_limits_groups_before_the_shuffle(tables):
    top = windows.top_per_group(keyword_traffic(tables), ["product_type"], [F.desc("impressions")], 5)
    text = plan(top)
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_global_top_k_is_a_bounded_heap(tables):
    text = plan(tables.orders.orderBy(F.desc("o_totalprice")).limit(10))
    assert "TakeOrderedAndProject" in text


def test_filters_and_columns_reach_the_scan(spark, folder):
    df = runnable()["filter_allowlist"](spark, folder)
    assert "PushedFilters: [In(p_type" in plan(df).replace("IsNotNull(p_type), ", "")
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in plan(df)


def test_keyword_traffic_reads_only_its_columns(tables):
    text = plan(keyword_traffic(tables))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_no_full_group_windows_on_raw_rows(spark, folder):
    """Ranking queries work per slice, never with one window over a whole group."""
    for name in ("pareto_head", "running_sum", "join_group_total_back", "group_total_broadcast"):
        text = plan(runnable()[name](spark, folder))
        for line in text.splitlines():
            if "Window [" in line and "_part" not in line and "_before" not in line and "total_value" not in line:
                assert "_slice" in line, line


def test_prefix_join_is_an_equi_join(spark):
    roots = spark.createDataFrame([("a",), ("a, b",)], "root string")
    nodes = spark.createDataFrame([("a, b, c",), ("ab",)], "path string")
    out = joins.leaves_under(roots, nodes, "root", "path")
    # "ab" starts with "a" too: a root may end inside an element
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out) and out.count() == 3


@pytest.mark.parametrize("name", ["filter_calendar", "split_by_time", "target_encode"])
def test_calendar_filters_reach_the_scan_as_date_ranges(spark, folder, name):
    assert "GreaterThanOrEqual(" in plan(runnable()[name](spark, folder))


def test_infer_join_does_not_shuffle_the_prompt(spark, folder):
    out = runnable()["dedupe_before_infer"](spark, folder)
    for line in plan(out).splitlines():
        if "Exchange" in line:
            assert "prompt" not in line


def test_no_option_list_is_shuffled_before_the_call(spark):
    rows = spark.range(50).select("id", F.lit("c").alias("cat"), F.col("id").cast("string").alias("title"))
    options = spark.createDataFrame([("c", "x"), ("c", "y")], "cat string, o string")
    dealt = joins.with_group_options(rows.repartition(4), options, ["cat"], "o")
    for line in plan(dealt).splitlines():
        if "Exchange" in line and "Broadcast" not in line:
            assert "options" not in line, line
