"""Before and after a cleaning, side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import METRIC_LABELS
from clearbrook.operators.joins import one_row

MISSING = "—"


def side_by_side(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two one-row records as one row with ``_before`` and ``_after`` columns."""
    return one_row(
        before.withColumnsRenamed({c: f"{c}_before" for c in before.columns}),
        after.withColumnsRenamed({c: f"{c}_after" for c in after.columns}),
    )


def before_after_wide(before: DataFrame, after: DataFrame) -> DataFrame:
    """Thirteen columns from two (n, dup_est, p01, p99) records."""
    both = side_by_side(before, after)
    outputs = []
    for metric, name in (("n", "n"), ("dup_est", "dup"), ("p01", "p01"), ("p99", "p99")):
        b, a = F.col(f"{metric}_before"), F.col(f"{metric}_after")
        outputs += [b.alias(f"{name}_before"), a.alias(f"{name}_after"), (a - b).alias(f"{name}_delta")]
    n = F.col("n_before").cast("double")
    share = (F.col("n_after") - n) / F.nullif(n, F.lit(0.0))
    return both.select(*outputs, share.alias("n_pct_delta"))


def before_after_long(
    before: DataFrame, after: DataFrame, labels: Sequence[tuple[str, str, int]] = METRIC_LABELS
) -> DataFrame:
    """One row per metric; the delta is NULL when a side is missing."""
    both = side_by_side(before, after)
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"), F.lit(label).alias("label"), F.lit(digits).alias("digits"),
                F.col(f"{metric}_before").cast("double").alias("before"),
                F.col(f"{metric}_after").cast("double").alias("after"),
            )
            for metric, label, digits in labels
        ]
    )
    return both.select(F.inline(rows)).withColumn("delta", F.col("after") - F.col("before"))


def _number(value: Column) -> Column:
    two, none = F.format_number(value, 2), F.format_number(value, 0)
    return F.when(F.col("digits") > 0, two).otherwise(none)


def formatted(long: DataFrame) -> DataFrame:
    """The long table as text: thousands separators, signed delta, a dash for NULL."""
    sign = F.when(F.col("delta") < 0, "-").otherwise("+")
    return long.select(
        "label",
        F.coalesce(_number(F.col("before")), F.lit(MISSING)).alias("before"),
        F.coalesce(_number(F.col("after")), F.lit(MISSING)).alias("after"),
        F.coalesce(F.concat(sign, _number(F.abs("delta"))), F.lit(MISSING)).alias("delta"),
    )
