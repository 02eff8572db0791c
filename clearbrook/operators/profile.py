"""Quality metrics of a table, each as a one-row frame.

Duplicate figures come from one count per key, which combines on the map side:
a key shared by a third of the rows is a handful of partial counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import (
    CHANNEL_COLUMN_CANDIDATES,
    CHANNEL_DOMAIN,
    KEYS,
    P_HIGH,
    P_LOW,
)
from clearbrook.functions.scalars import not_positive, off_domain
from clearbrook.operators.joins import one_row
from clearbrook.operators.quantiles import exact_quantiles


def key_counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def duplicate_groups(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that occur more than once (NULLs count as equal), with their count."""
    return key_counts(df, keys).where("cnt > 1")


def duplicate_summary(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``n_dup_pairs`` repeated keys, ``n_dup_rows`` rows that carry them."""
    return duplicate_groups(df, keys).agg(
        F.count(F.lit(1)).alias("n_dup_pairs"),
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("n_dup_rows"),
    )


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def duplicate_estimate(df: DataFrame, keys: Sequence[str] = KEYS, null_keys: bool = False) -> DataFrame:
    """Rows minus distinct complete keys.

    A row whose key has a NULL part therefore counts as a duplicate;
    ``null_keys=True`` adds how many such rows there are.
    """
    incomplete = _any_null(keys)
    outputs = [
        F.coalesce(F.sum(F.col("cnt") - F.when(incomplete, 0).otherwise(1)), F.lit(0)).cast("long").alias("dup_est")
    ]
    if null_keys:
        outputs.append(
            F.coalesce(F.sum(F.when(incomplete, F.col("cnt"))), F.lit(0)).cast("long").alias("n_null_key")
        )
    return key_counts(df, keys).agg(*outputs)


def _invalid(customer: str, price: str, quantity: str, day: str) -> dict[str, Column]:
    """Conditions of the baseline's counters."""
    return {
        "n_missing_customer": F.col(customer).isNull(),
        "n_price_zero_or_null": not_positive(price),
        "n_qty_invalid": not_positive(quantity),
        "n_date_null": F.col(day).isNull(),
    }


def invalid_counts(
    df: DataFrame,
    customer: str = "customer_id",
    price: str = "unit_price",
    quantity: str = "quantity",
    day: str = "date_parsed",
) -> DataFrame:
    counters = _invalid(customer, price, quantity, day)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(name) for name, c in counters.items()])


def counts_with_keys(df: DataFrame, keys: Sequence[str], counters: Mapping[str, Column], figures: Sequence[Column]) -> DataFrame:
    """Counters over rows and figures over keys in one aggregation by key.

    ``figures`` aggregate ``cnt``, the rows of each key; both come out of one pass and one shuffle.
    """
    by_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), *[F.count_if(c).alias(name) for name, c in counters.items()])
    return by_key.agg(
        F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("n_rows"), *figures,
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in counters],
    )


def price_percentiles(
    df: DataFrame,
    column: str = "unit_price",
    low: float = P_LOW,
    high: float = P_HIGH,
    by: Sequence[str] = (),
    population: str = "nonnull",
    method: str = "distributed",
) -> DataFrame:
    """``p01`` and ``p99`` (or other cut-offs) of all or of the positive values."""
    if population == "positive":
        df = df.where(F.col(column) > 0)
    elif population != "nonnull":
        raise ValueError(f"unknown population: {population}")
    return exact_quantiles(df, column, {"p01": low, "p99": high}, by, method=method)


def baseline_checks(df: DataFrame, keys: Sequence[str] = KEYS, method: str = "distributed") -> DataFrame:
    """The nine-figure baseline record."""
    repeated = F.col("cnt") > 1
    counts = counts_with_keys(
        df, keys, _invalid("customer_id", "unit_price", "quantity", "date_parsed"),
        [
            F.count_if(repeated).alias("n_dup_pairs"),
            F.coalesce(F.sum(F.when(repeated, F.col("cnt"))), F.lit(0)).cast("long").alias("n_dup_rows"),
        ],
    )
    record = one_row(counts, price_percentiles(df, method=method))
    return record.select(
        "n_rows", "n_dup_pairs", "n_dup_rows", "n_missing_customer", "n_price_zero_or_null",
        "n_qty_invalid", "n_date_null", "p01", "p99",
    )


def label_column(df: DataFrame, candidates: Sequence[str] = CHANNEL_COLUMN_CANDIDATES) -> Column:
    """First candidate the table has; a NULL string when it has none."""
    present = [c for c in candidates if c in df.columns]
    return F.col(present[0]) if present else F.lit(None).cast("string")


def table_metrics(
    df: DataFrame,
    label: str | None = None,
    domain: Sequence[str] = CHANNEL_DOMAIN,
    keys: Sequence[str] = KEYS,
    price: str = "unit_price",
    customer: str = "customer_id",
    method: str = "distributed",
) -> DataFrame:
    """Metrics that exist on both sides of a cleaning step."""
    chosen = F.col(label) if label else label_column(df)
    counts = df.select(F.col(price).alias("p"), F.col(customer).alias("c"), chosen.alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(not_positive("p")).alias("n_price_zero_or_null"),
        F.count_if(F.col("c").isNull()).alias("n_missing_customer"),
        F.count_distinct("label").alias("n_channel_labels"),
        F.count_if(off_domain("label", domain)).alias("n_channel_off_domain"),
    )
    record = one_row(counts, duplicate_estimate(df, keys), price_percentiles(df, price, method=method))
    return record.select(
        "n", "dup_est", "n_price_zero_or_null", "n_missing_customer", "n_channel_labels",
        "n_channel_off_domain", "p01", "p99",
    )


def metrics_nonnull_price(
    df: DataFrame, keys: Sequence[str] = KEYS, price: str = "unit_price", method: str = "distributed"
) -> DataFrame:
    """Rows, duplicates and percentiles over rows that have a price."""
    priced = df.where(F.col(price).isNotNull())
    record = one_row(
        priced.agg(F.count(F.lit(1)).alias("n")), duplicate_estimate(priced, keys),
        price_percentiles(priced, price, method=method),
    )
    return record.select("n", "dup_est", "p01", "p99")


def stack_metrics(records: Mapping[str, DataFrame]) -> DataFrame:
    """One-row records below each other, told apart by ``stage``."""
    tagged = [m.select(F.lit(stage).alias("stage"), "*") for stage, m in records.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
