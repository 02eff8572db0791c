"""Properties of plans that decide whether they hold at a thousand times the data."""

import re

import pytest

from clearbrook.operators.clean import clean
from clearbrook.operators.dedupe import dedupe
from clearbrook.operators.profile import duplicate_summary, price_percentiles
from clearbrook.operators.seasonality import seasonality
from clearbrook.plans import catalog
from clearbrook.session import scratch_path, scratch_root
from clearbrook.sources.files import read_table
from clearbrook.sources.sales import sales_staged


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


# Queries that write tables or run streams while they are built are left out.
LAZY = [
    "stage_sales_rows", "baseline_checks", "metrics_table", "daily_rollup", "seasonality_daily", "label_variants", "winsorize_global",
    "winsorize_by_group", "dedupe_deterministic", "dedupe_lineitem", "clean_reference", "clean_reference_distributed", "clean_agent_variant",
    "clean_legacy", "contract_violations", "idempotent_append", "trim_outliers", "outliers_vs_median", "percentiles_by_group_distributed",
    "seasonality_full_calendar", "classify_days_calendar",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins(spark, folder, name):
    text = plan(catalog.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(spark, folder):
    text = plan(dedupe(sales_staged(spark, folder)))
    assert re.search(r"WindowGroupLimit .*Final[\s\S]*Exchange hashpartitioning\(order_id[\s\S]*WindowGroupLimit .*Partial", text)
    assert text.count("Exchange") == 1


def test_cleaning_shuffles_rows_once(spark, folder):
    """Bounds come as a scalar subquery, not as a join."""
    text = plan(clean(sales_staged(spark, folder)))
    main = text.split("Subquery subquery", 1)[0] + text.rsplit("WindowGroupLimit", 2)[1]
    assert "Join" not in text and main.count("Exchange hashpartitioning(order_id") == 1


def test_counts_are_combined_before_the_shuffle(spark, folder):
    text = plan(duplicate_summary(sales_staged(spark, folder)))
    assert "partial_count" in text


@pytest.mark.parametrize(
    "build, columns",
    [
        (lambda li: price_percentiles(li, "l_extendedprice", by=["l_suppkey"]), {"l_suppkey", "l_extendedprice"}),
        (lambda li: price_percentiles(li, "l_extendedprice", method="distributed"), {"l_extendedprice"}),
        (lambda li: duplicate_summary(li, ["l_orderkey", "l_shipdate"]), {"l_orderkey", "l_shipdate"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, folder, build, columns):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan(build(read_table(spark, folder, "lineitem"))))
    assert schemas and all({part.split(":")[0] for part in s.split(",")} == columns for s in schemas)


def test_staged_metrics_read_few_columns_and_push_filters(spark, folder):
    text = plan(seasonality(sales_staged(spark, folder)))
    assert "props" not in text and "PushedFilters: [" in text


def test_distributed_quantiles_hold_no_value_map(spark, folder):
    text = plan(price_percentiles(read_table(spark, folder, "lineitem"), "l_extendedprice", by=["l_suppkey"], method="distributed"))
    assert "percentile(" not in text and "collect_list" not in text


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
