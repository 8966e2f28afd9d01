"""What the physical plans must and must not contain."""

import contextlib
import io

import pytest

from millrace.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load_all()


def plan(spark, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        QUERIES[name](spark, SF).explain("formatted")
    return text.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "bounds_filter")
    assert "GreaterThanOrEqual(l_quantity,5.0)" in text and "LessThanOrEqual(l_discount,0.09)" in text
    assert "l_shipdate" not in text
    text = plan(spark, "mart_counts_known")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in text


def test_dedup_drops_rows_before_the_shuffle(spark):
    assert plan(spark, "dedup_latest").count("WindowGroupLimit") >= 2


def test_preview_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in plan(spark, "mart_counts_preview")


def test_group_values_use_no_window(spark):
    text = plan(spark, "zone_hour_features")
    assert "Window" not in text and "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_mart_aggregates_before_its_shuffle(spark):
    text = plan(spark, "mart_product_month")
    assert text.count("HashAggregate") >= 3 and "SortAggregate" not in text


EAGER = {"classify_documents", "ranker", "factor_top_n", "stream_events", "stream_metric_5min"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_row_python(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "MapInPandas" not in text or name.startswith("topk_similar")
