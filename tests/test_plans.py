"""The physical plans that the design counts on."""

import re

import pytest

from marketspark.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    df = catalog.QUERIES[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


@pytest.mark.parametrize("name", [
    "silver_unified", "silver_returns", "dedupe_latest", "dedupe_first", "window_half_open", "fx_rejects",
    "equity_rejects", "log_returns", "squared_returns", "gold_market_wide", "gold_market_window",
    "gold_returns_wide", "weekly_performance", "coverage_report", "coverage_from_paths",
    "ingest_worklist", "missing_dates", "missing_report", "keep_first_landing", "landing_summary",
    "pair_outcomes", "vendor_wide_to_long", "ticker_key", "bronze_enriched",
])
def test_no_single_partition_no_cross_join_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert bad not in text


def test_dedupe_cuts_each_key_before_the_shuffle(spark):
    text = plan(spark, "silver_unified")
    shuffle = text.index("Exchange hashpartitioning")
    limits = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    assert len(limits) == 2 and limits[0] < shuffle < limits[1]
    assert exchanges(text) == ["hashpartitioning"]


def test_shuffle_counts(spark):
    assert len(exchanges(plan(spark, "silver_returns"))) == 2
    assert len(exchanges(plan(spark, "gold_market_wide"))) == 3
    assert len(exchanges(plan(spark, "weekly_performance"))) == 2
    assert len(exchanges(plan(spark, "vendor_wide_to_long"))) == 1
    assert len(exchanges(plan(spark, "fx_rejects"))) == 0


def test_gold_does_not_compute_simple_returns(spark):
    assert plan(spark, "gold_market_wide").count("lag(") == 1


def test_scan_reads_needed_columns_and_filters(spark):
    text = plan(spark, "gold_market_window")
    assert "l_returnflag" not in text and "o_orderstatus" not in text
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(l_shipdate" in text


def test_top_k_is_not_a_full_sort(spark):
    text = plan(spark, "top_performers")
    assert "TakeOrderedAndProject" in text and "Subquery" in text


def test_weekly_hashes(spark):
    text = plan(spark, "weekly_performance")
    assert "HashAggregate" in text and "SortAggregate" not in text
