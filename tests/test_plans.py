"""The physical plans: nothing quadratic, nothing row-at-a-time, columns pruned."""

import re

import pytest

from tidemark.plans import QUERIES

LAZY = [
    "log_parse",
    "log_clean",
    "log_classify",
    "status_counts",
    "error_trends",
    "popular_products",
    "suspicious_ips",
    "event_pivot",
    "unit_price_filter",
    "standardize",
    "min_max_scale",
    "target_correlation",
    "corr_matrix",
    "class_proportions",
    "minmax_profile",
    "confusion_matrix",
    "classification_report",
    "regression_metrics",
    "score_rows",
    "score_summary",
]


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in text


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("event_pivot", {"user_id", "event_type"}),
        ("unit_price_filter", {"l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"}),
        ("regression_metrics", {"l_orderkey", "l_quantity", "l_extendedprice"}),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(spark, sf_dir, name))
    assert schemas and {field.split(":")[0] for s in schemas for field in s.split(",")} == columns


def test_patterns_are_evaluated_once(spark, sf_dir):
    text = plan(spark, sf_dir, "popular_products")
    generator = text.index("Generate inline")
    # The filter sits above the generator and sees plain columns.
    assert "regexp_extract" not in text[:generator]


def test_counts_are_partial_before_the_shuffle(spark, sf_dir):
    text = plan(spark, sf_dir, "suspicious_ips")
    assert text.index("Exchange hashpartitioning") < text.index("partial_count(1)")
