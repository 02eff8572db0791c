import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearbrook.operators.clean import clean
from clearbrook.operators.profile import baseline_checks, table_metrics
from clearbrook.operators.quantiles import SLICES, _magnitude_bucket, _slice, exact_quantiles
from clearbrook.operators.winsor import (
    outliers_vs_median, percentile_drift, trim_outliers, winsor_bounds, winsorize, winsorize_by_group,
)

PROBABILITIES = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99}


def expected(values):
    return [float(np.quantile(np.array(values), p)) for p in PROBABILITIES.values()]


def close(got, want):
    return all(math.isclose(g, w, rel_tol=1e-12, abs_tol=1e-300) for g, w in zip(got, want))


@pytest.mark.parametrize("method", ["gathered", "distributed"])
def test_hot_group_hot_value_and_odd_values(spark, method):
    random.seed(7)
    groups = {
        "hot": [1.5] * 400 + [random.lognormvariate(0, 3) for _ in range(600)],
        "negative": [random.uniform(-1e9, -1e-9) for _ in range(301)],
        "around zero": [0.0, -0.0, 1e-310, -1e-310] * 25 + [random.gauss(0, 1e-5) for _ in range(100)],
        "one": [42.0],
        "two": [1.0, 2.0],
        "narrow": [1000 + i * 1e-9 for i in range(500)],
        None: [float(i) for i in range(11)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("hot", None), ("only nulls", None)]
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "g string, v double").repartition(5)
    found = {r["g"]: r for r in exact_quantiles(frame, "v", PROBABILITIES, ["g"], "n", method).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g]["n"] == len(values)
        assert close([found[g][p] for p in PROBABILITIES], expected(values)), g


@pytest.mark.parametrize("method", ["gathered", "distributed"])
def test_infinities_and_nan_sort_last(spark, method):
    values = [float("-inf"), -1.0, 0.0, 1.0, float("inf"), float("nan"), float("nan")]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    probabilities = {"first": 0.0, "third": 2 / 6, "fifth": 4 / 6, "last": 1.0}
    row = exact_quantiles(frame, "v", probabilities, method=method).first()
    assert row["first"] == float("-inf") and row["third"] == 0.0 and row["fifth"] == float("inf") and math.isnan(row["last"])


@pytest.mark.parametrize("method", ["gathered", "distributed"])
def test_empty_input_gives_one_row_of_nulls(spark, method):
    frame = spark.createDataFrame([], "v double")
    row = exact_quantiles(frame, "v", PROBABILITIES, count_as="n", method=method).first()
    assert row["n"] == 0 and all(row[p] is None for p in PROBABILITIES)


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60), min_size=5, max_size=40
    )
)
def test_both_ways_agree_with_brute_force(spark, groups):
    rows = [(g, float(v)) for g, values in enumerate(groups) for v in values]
    frame = spark.createDataFrame(rows, "g int, v double").repartition(3)
    for method in ("gathered", "distributed"):
        found = {r["g"]: r for r in exact_quantiles(frame, "v", PROBABILITIES, ["g"], method=method).collect()}
        for g, values in enumerate(groups):
            ordered = sorted(values)
            for name, p in PROBABILITIES.items():
                position = p * (len(ordered) - 1)
                low, high = ordered[math.floor(position)], ordered[math.ceil(position)]
                want = low + (high - low) * (position - math.floor(position))
                assert math.isclose(found[g][name], want, rel_tol=1e-9, abs_tol=1e-9 * max(1.0, abs(low), abs(high)))


def test_both_ways_agree_to_the_last_bit(spark):
    pick = random.Random(1)
    rows = [(g, pick.choice([pick.uniform(0, 1e4), pick.gauss(0, 1), 1.7e15 + pick.randrange(10**6)])) for g in range(30) for _ in range(pick.randint(1, 90))]
    frame = spark.createDataFrame(rows, "g int, v double").repartition(4)
    ways = [{r["g"]: tuple(r) for r in exact_quantiles(frame, "v", PROBABILITIES, ["g"], "n", m).collect()} for m in ("gathered", "distributed")]
    assert ways[0] == ways[1]
    with pytest.raises(ValueError):
        exact_quantiles(frame, "v", PROBABILITIES, method="guess")


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_three_scans_and_three_windows(spark, tmp_path, by):
    spark.range(100).selectExpr("id % 5 AS g", "id % 3 AS h", "cast(id AS double) AS v").write.parquet(f"{tmp_path}/t")
    built = exact_quantiles(spark.read.parquet(f"{tmp_path}/t"), "v", PROBABILITIES, by, "n")
    execution = built._jdf.queryExecution()
    text = execution.optimizedPlan().toString()
    assert text.count("Relation [") + text.count("Relation[") <= 3
    assert text.count("Window [") <= 3
    assert ("Join" in text) == bool(by)
    # The plan does not grow with the number of quantiles.
    many = exact_quantiles(spark.read.parquet(f"{tmp_path}/t"), "v", {f"q{k}": k / 20 for k in range(21)}, by)
    wide = many._jdf.queryExecution().optimizedPlan().toString()
    assert wide.count("Window [") == text.count("Window [") and wide.count("Join") == text.count("Join")


def test_prefixes_follow_the_order_of_values(spark):
    """From the smallest double to infinity, around zero, around every bucket's bounds."""
    pick = random.Random(3)
    values = [0.0, 5e-324, 2.2e-308, 1.7e308, float("inf"), 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2)]
    values += [2.0 ** (k / 7) for k in range(-7000, 7000, 13)] + [math.nextafter(2.0 ** (k / 256), 0) for k in range(-600, 600)]
    values += [2.0 ** (k / 256) for k in range(-600, 600)] + [pick.lognormvariate(0, 40) for _ in range(3000)]
    values = sorted({s * v for v in values for s in (1, -1)})
    frame = spark.createDataFrame([(v,) for v in values], "x double").select("x", _magnitude_bucket(F.col("x")).alias("b"))
    cells = [(r["b"], r["s"]) for r in frame.select("x", "b", _slice(F.col("x"), F.col("b")).alias("s")).orderBy("x").collect()]
    assert cells == sorted(cells)
    assert all(abs(s) <= SLICES for _, s in cells) and len(set(cells)) > len(values) * 0.6


@pytest.mark.parametrize(
    "build",
    [clean, baseline_checks, table_metrics, lambda df: winsorize_by_group(df, ["product_id"]), outliers_vs_median],
    ids=["clean", "baseline_checks", "table_metrics", "winsorize_by_group", "outliers_vs_median"],
)
def test_no_job_runs_while_a_plan_is_built(spark, sales, build, request):
    frame, group = sales(("1", "2025-07-01", "S", "P", 10.0)), request.node.name
    spark.sparkContext.setJobGroup(group, group)
    try:
        built = build(frame)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
        built.collect()
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) != []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bounds_populations(sales):
    frame = sales(*[(str(i), "2025-07-01", "S", "P", float(i)) for i in range(-10, 101)], ("n", "2025-07-01", "S", "P", None))
    assert winsor_bounds(frame, low=0.0, high=1.0, population="nonnull").first()["p01"] == -10.0
    assert winsor_bounds(frame, low=0.0, high=1.0).first()["p01"] == 1.0
    with pytest.raises(ValueError):
        winsor_bounds(frame, population="all")


def test_group_of_one_and_null_group(spark):
    rows = [("a", 5.0), (None, 9.0), (None, 100.0), ("b", None), ("c", 1.0), ("c", 2.0), ("c", 300.0)]
    frame = spark.createDataFrame(rows, "product_id string, unit_price double")
    got = winsorize_by_group(frame, ["product_id"], output="w", low=0.0, high=0.5).collect()
    by = sorted(((r["product_id"] or "", r["unit_price"] or -1.0, r["w"]) for r in got), key=repr)
    # A NULL group never meets its bounds, so its rows stay as they are.
    assert by == sorted(
        [("a", 5.0, 5.0), ("", 9.0, 9.0), ("", 100.0, 100.0), ("b", -1.0, None), ("c", 1.0, 1.0), ("c", 2.0, 2.0), ("c", 300.0, 2.0)],
        key=repr,
    )


def test_trim_removes_what_winsorize_clamps(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(1, 101)] + [(None,)], "unit_price double")
    bounds = winsor_bounds(frame, low=0.05, high=0.95)
    kept = {r[0] for r in trim_outliers(frame, bounds).collect()}
    clamped = [r[0] for r in winsorize(frame, bounds).collect()]
    assert len(kept) == 90 and min(kept) == 6.0 and max(kept) == 95.0
    assert len(clamped) == 101 and min(c for c in clamped if c is not None) == pytest.approx(5.95) and None in clamped


def test_outliers_and_drift(spark, sales):
    frame = sales(*[(str(i), "2025-07-01", "S", "P", 10.0) for i in range(20)], ("x", "2025-07-01", "S", "P", 100.1), ("y", "2025-07-01", "S", "P", 100.0))
    assert [r["order_id"] for r in outliers_vs_median(frame).collect()] == ["x"]
    two_weeks = sales(("1", "2025-07-01", "S", "P", 10.0), ("2", "2025-07-08", "S", "P", 12.0), ("3", None, "S", "P", 99.0))
    rows = percentile_drift(two_weeks).orderBy("period").collect()
    assert [(str(r["period"]), r["p99"], r["p99_change"]) for r in rows] == [("2025-06-30", 10.0, None), ("2025-07-07", 12.0, 2.0)]
