"""Outlier bounds and what can be done with values outside them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.fixed_values import OUTLIER_MEDIAN_FACTOR, P_HIGH, P_LOW
from clearbrook.functions.clamps import clamp_positive, clip, outside
from clearbrook.operators.profile import price_percentiles
from clearbrook.operators.quantiles import exact_quantiles

Clamp = Callable[[Column | str, Column, Column], Column]


def winsor_bounds(
    df: DataFrame, column: str = "unit_price", low: float = P_LOW, high: float = P_HIGH,
    population: str = "positive", by: Sequence[str] = (), method: str = "distributed",
) -> DataFrame:
    return price_percentiles(df, column, low, high, by, population, method)


def attach_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Add the single bounds row to every row, as a struct ``__bounds``.

    A scalar subquery: the bounds are computed once and reach the tasks as a
    constant, without a join.
    """
    return df.withColumn("__bounds", bounds.select(F.struct("p01", "p99")).scalar())


def winsorize(
    df: DataFrame, bounds: DataFrame, column: str = "unit_price", output: str | None = None,
    clamp: Clamp = clamp_positive,
) -> DataFrame:
    """Clamp one column into the global bounds."""
    bounded = attach_bounds(df, bounds)
    value = clamp(F.col(column), F.col("__bounds.p01"), F.col("__bounds.p99"))
    return bounded.withColumn(output or column, value).drop("__bounds")


def winsorize_fixed(df: DataFrame, low: float, high: float, column: str = "unit_price", output: str | None = None) -> DataFrame:
    """Clamp into documented bounds; nothing is measured."""
    return df.withColumn(output or column, clip(column, F.lit(low), F.lit(high)))


def with_group_bounds(df: DataFrame, bounds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Left join of per-group bounds; rows with a NULL group keep NULL bounds.

    Adaptive execution broadcasts the bounds when they turn out small, and
    splits a group that holds a large share of the rows when they do not.
    """
    return df.join(bounds, list(by), "left")


def winsorize_by_group(
    df: DataFrame, by: Sequence[str], column: str = "unit_price", output: str | None = None,
    low: float = P_LOW, high: float = P_HIGH, population: str = "nonnull", clamp: Clamp = clip,
    method: str = "distributed",
) -> DataFrame:
    """Clamp into the bounds of the row's own group."""
    bounds = winsor_bounds(df, column, low, high, population, by, method)
    joined = with_group_bounds(df, bounds, by)
    clamped = clamp(F.col(column), F.col("p01"), F.col("p99"))
    return joined.withColumn(output or column, clamped).drop("p01", "p99")


def trim_outliers(df: DataFrame, bounds: DataFrame, column: str = "unit_price") -> DataFrame:
    """Remove rows outside the bounds instead of clamping them; NULLs go too."""
    bounded = attach_bounds(df, bounds)
    return bounded.where(F.col(column).between(F.col("__bounds.p01"), F.col("__bounds.p99"))).drop("__bounds")


def outliers_vs_median(
    df: DataFrame, by: Sequence[str] = ("product_id",), column: str = "unit_price",
    factor: float = OUTLIER_MEDIAN_FACTOR, method: str = "distributed",
) -> DataFrame:
    """Rows whose value exceeds ``factor`` times the median of their group."""
    positive = df.where(F.col(column) > 0)
    medians = exact_quantiles(positive, column, {"median": 0.5}, by, method=method)
    joined = positive.join(medians, list(by))
    return joined.where(F.col(column) > factor * F.col("median"))


def percentile_drift(
    df: DataFrame, day: str = "date_parsed", column: str = "unit_price", period: str = "week",
    low: float = P_LOW, high: float = P_HIGH, method: str = "distributed",
) -> DataFrame:
    """Percentiles per calendar period and their change since the previous one."""
    dated = df.where(F.col(day).isNotNull()).withColumn("period", F.date_trunc(period, F.col(day)).cast("date"))
    series = exact_quantiles(dated, column, {"p01": low, "p99": high}, ["period"], "n", method)
    by_time = Window.orderBy("period")  # one row per period: bounded by the calendar
    return series.select(
        "period", "n", "p01", "p99",
        (F.col("p01") - F.lag("p01").over(by_time)).alias("p01_change"),
        (F.col("p99") - F.lag("p99").over(by_time)).alias("p99_change"),
    )


def was_winsorized(column: str, low: Column, high: Column) -> Column:
    return outside(column, low, high)
