"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from millrace import plans
from millrace.operators import ranking as rk
from millrace.sources.tables import load

# number a whole table: the summaries of its blocks (about the square root of
# its rows) meet in one task, the rows never do
WHOLE_TABLE = {"merge_sorted_distinct", "sort_global"}
STREAMS = {n for n in plans.QUERIES if n.startswith("stream_") or n in ("state_snapshot", "sink_rolling_files", "sink_idempotent_batches")}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - STREAMS))
def test_no_cartesian_and_no_single_task_window(spark, sf, name):
    text = plan(plans.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    if name not in WHOLE_TABLE and not re.search(r"keys=\[\], functions=|GlobalLimit|TakeOrdered", text):
        assert "Exchange SinglePartition" not in text


def test_filter_and_columns_reach_the_scan(spark, sf):
    text = plan(plans.QUERIES["proj_filter"](spark, sf))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(l_quantity", text)
    assert "l_extendedprice" not in text


def test_word_count_reads_one_column_and_combines_before_the_shuffle(spark, sf):
    text = plan(plans.QUERIES["word_count"](spark, sf))
    assert "ReadSchema: struct<text:string>" in text
    assert "partial_count(1)" in text


def test_bucketed_join_has_no_shuffle(spark, sf):
    text = plan(plans.QUERIES["ddl_bucketed_join"](spark, sf))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_top_per_group_limits_before_the_shuffle(spark, sf):
    orders = load(spark, sf, "orders")
    for df in (
        rk.top_per_group(orders, ["o_custkey"], [F.desc("o_totalprice")], 3),
        rk.kth_per_group(load(spark, sf, "lineitem"), ["l_partkey"], "l_extendedprice", 2),
    ):
        text = plan(df)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_interval_join_is_an_equi_join(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(plans.QUERIES["join_interval"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[user_id#\d+L, __slot#\d+L\]", text)


def test_scan_without_hot_keys_is_one_shuffle(spark, sf):
    text = plan(plans.QUERIES["win_lag_lead"](spark, sf))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1


def test_latest_per_key_combines_before_the_shuffle(spark, sf):
    assert "partial_max_by" in plan(plans.QUERIES["dedup_latest"](spark, sf))


def test_whole_table_numbering_goes_through_blocks(spark, sf):
    from millrace.operators import scan as sc

    numbered = sc.scan(load(spark, sf, "orders").select("o_orderkey"), [], ["o_orderkey"], hot_rows=100, n=sc.row_number())
    text = plan(numbered)
    assert re.search(r"Exchange hashpartitioning\(__block", text) and "Exchange SinglePartition" not in text
    assert "NestedLoopJoin" not in text
    assert numbered.agg(F.max("n"), F.count_distinct("n")).first() == (1500, 1500)
