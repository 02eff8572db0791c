"""Daily evidence that tells a business swing from a pipeline defect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.fixed_values import DROP_THRESHOLD, MOVING_AVERAGE_DAYS, SPIKE_THRESHOLD
from clearbrook.functions.scalars import relative_deviation
from clearbrook.operators.joins import null_safe_join

SERIES_COLUMNS = (
    "d", "n_rows", "n_orders", "revenue", "ma7_prev", "n_rows_wow", "dev_vs_ma7", "dup_rows_no_dia",
)


def daily_rollup(
    df: DataFrame, day: str = "date_parsed", order: str = "order_id", amount: Column | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Rows, distinct orders and revenue per day.

    The distinct count is taken over (day, order) pairs first, so one busy day
    is spread over all reducers.
    """
    if amount is None:
        amount = F.col("unit_price") * F.col("quantity")
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(*partition_by, F.col(day).alias("d"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(order).alias("n_orders"),
            F.sum(amount).alias("revenue"),
        )
    )


def fill_calendar(daily: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Add the days nobody sold anything, with zero rows, between first and last day."""
    keys = [*partition_by, "d"]
    span = daily.groupBy(*partition_by).agg(F.min("d").alias("first"), F.max("d").alias("last"))
    calendar = span.select(*partition_by, F.explode(F.sequence("first", "last")).alias("d"))
    filled = null_safe_join(calendar, daily, keys, "left")
    return filled.select(
        *keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "n_orders", "revenue")]
    )


def with_history(daily: DataFrame, days: int = MOVING_AVERAGE_DAYS, partition_by: Sequence[str] = ()) -> DataFrame:
    """Mean of the previous days (today left out) and the value ``days`` rows back.

    Both look at rows, not at calendar days.  Without ``partition_by`` the
    window runs in one task, over one row per calendar day.
    """
    history = Window.partitionBy(*partition_by).orderBy("d")
    return daily.withColumns(
        {
            "ma7_prev": F.avg("n_rows").over(history.rowsBetween(-days, -1)),
            "n_rows_wow": F.lag("n_rows", days).over(history),
        }
    )


def seasonality(
    df: DataFrame, start: str | None = None, end: str | None = None, calendar_days: bool = False,
    partition_by: Sequence[str] = (), **columns,
) -> DataFrame:
    """The daily series between two dates.

    The date filter sits above the window on purpose: days before ``start``
    still feed the moving average of the first days shown.
    """
    daily = daily_rollup(df, partition_by=partition_by, **columns)
    if calendar_days:
        daily = fill_calendar(daily, partition_by)
    series = with_history(daily, partition_by=partition_by).withColumns(
        {
            "dev_vs_ma7": relative_deviation("n_rows", "ma7_prev"),
            "dup_rows_no_dia": F.col("n_rows") - F.col("n_orders"),
        }
    )
    if start:
        series = series.where(F.col("d") >= F.lit(start).cast("date"))
    if end:
        series = series.where(F.col("d") <= F.lit(end).cast("date"))
    return series.select(*partition_by, *SERIES_COLUMNS)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def seasonality_flags(
    series: DataFrame, drop: float = DROP_THRESHOLD, spike: float = SPIKE_THRESHOLD,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """Mark drops, spikes and days with excess rows; an unknown deviation is neither."""
    if days is not None:
        series = series.where(F.col("d").isin(*[F.lit(d).cast("date") for d in days]))
    return series.withColumns(
        {
            "is_drop": _flag(F.col("dev_vs_ma7") <= drop),
            "is_spike": _flag(F.col("dev_vs_ma7") >= spike),
            "has_excess_rows": _flag(F.col("dup_rows_no_dia") > 0),
        }
    )


def flagged_days(flags: DataFrame) -> DataFrame:
    """One row per (kind, day) for every mark that is set."""
    kinds = {"drop": "is_drop", "spike": "is_spike", "excess_rows": "has_excess_rows"}
    marks = F.array_compact(F.array(*[F.when(F.col(c), F.lit(k)) for k, c in kinds.items()]))
    return flags.select(F.explode(marks).alias("kind"), "d")


def classify_days(flags: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """A verdict per day.  Excess rows decide, not volume: they mean a defect.

    ``calendar`` has columns ``d`` and ``holiday``, one row per day; a drop
    on such a day is ``explained``.
    """
    holiday = F.lit(None).cast("string")
    if calendar is not None:
        flags = flags.join(calendar.groupBy("d").agg(F.min("holiday").alias("holiday")), "d", "left")
        holiday = F.col("holiday")
    verdict = (
        F.when(F.col("has_excess_rows"), "bug")
        .when(F.col("is_drop") & holiday.isNotNull(), "explained")
        .when(F.col("is_drop"), "business")
        .when(F.col("is_spike"), "unexplained_spike")
        .otherwise("normal")
    )
    return flags.withColumn("verdict", verdict)


def chart_series(series: DataFrame) -> DataFrame:
    """What a line chart of the series needs: month-day label, rows, moving average."""
    return series.select(F.date_format("d", "MM-dd").alias("day"), "n_rows", "ma7_prev")


def series_records_json(series: DataFrame) -> DataFrame:
    """Each day as a JSON record with ISO dates; NULLs are kept as null."""
    record = F.to_json(F.struct(*series.columns), {"dateFormat": "yyyy-MM-dd", "ignoreNullFields": "false"})
    return series.select(record.alias("record"))
