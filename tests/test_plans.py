"""Shapes of the physical plans, and results that must not depend on partitioning."""

import re

import pytest
from conftest import rows

from barloom.operators.recent import last_rows_per_key, latest_per_key
from barloom.plans import catalog, features
from barloom.sources import derived as src

LAZY = ("asof_chain", "asof_keyed", "features", "features_wide", "features_wide_chunked",
        "quality_report", "latest_features", "last_30_rows", "training_rows", "temporal_split",
        "drift_window_counts", "load_watermark", "ingestion_audit", "check_staleness",
        "check_missing_keys", "scaler_params", "rsi_update_join")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_windows_share_one_exchange(spark, sf_dir):
    stored = spark.createDataFrame(
        src.bars_wide(spark, sf_dir).limit(0).collect(), src.bars_wide(spark, sf_dir).schema)
    text = plan(features.add_windows(stored))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_scan_bounds_reach_the_files(spark, sf_dir):
    text = catalog.scan_bars(spark, sf_dir)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
    assert pushed and all("GreaterThanOrEqual(o_orderdate,1998-01-01" in line and "LessThan(o_orderdate," in line
                          and "In(o_orderpriority" in line for line in pushed)


def test_feature_plan(spark, sf_dir):
    text = plan(catalog._features(spark, sf_dir))
    # Keyed by ticker once, for the windows before and after the as-of join alike.
    assert len(re.findall(r"hashpartitioning\(ticker#\d+, \d+\)", text)) == 1
    assert text.count("BroadcastHashJoin") >= 2
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    text = plan(catalog.window_column("ma_5")(spark, sf_dir))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text
    purchases, _ = catalog._purchases_and_clicks(spark, sf_dir)
    assert "EqualTo(event_type,purchase)" in plan(purchases)


def test_group_limit_runs_before_the_shuffle(spark, sf_dir):
    text = plan(last_rows_per_key(src.bars_wide(spark, sf_dir), 30))
    assert text.index("WindowGroupLimit") < text.rindex("WindowGroupLimit")


def test_latest_rows_combine_before_the_shuffle(spark, sf_dir):
    text = plan(latest_per_key(src.bars_wide(spark, sf_dir)))
    assert "partial_max_by" in text and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["features", "asof_keyed_sliced", "features_wide_chunked"])
def test_results_do_not_depend_on_partitions(spark, sf_dir, name):
    results = []
    for partitions in ("1", "8", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(rows(catalog.QUERIES[name](spark, sf_dir)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == results[2]
