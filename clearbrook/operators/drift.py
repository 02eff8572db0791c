"""Which spellings of a label occur, and which are outside the domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import CHANNEL_DOMAIN
from clearbrook.functions.scalars import off_domain


def label_variants(df: DataFrame, raw: str = "channel_raw", normalized: str = "channel_norm") -> DataFrame:
    """Rows per spelling, most frequent first, ties by spelling."""
    counted = df.groupBy(raw, normalized).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.col(raw).asc_nulls_last(), F.col(normalized).asc_nulls_last())


def label_drift(
    df: DataFrame, domain: Sequence[str] = CHANNEL_DOMAIN, raw: str = "channel_raw", normalized: str = "channel_norm",
) -> DataFrame:
    """The variants with a marker for those in the expected domain."""
    return label_variants(df, raw, normalized).withColumn("in_domain", ~off_domain(normalized, domain))


def label_off_domain(drift: DataFrame) -> DataFrame:
    return drift.where(~F.col("in_domain"))


def off_domain_total(drift: DataFrame) -> DataFrame:
    """Rows and spellings outside the domain."""
    return label_off_domain(drift).agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_labels")
    )


def label_topk(df: DataFrame, k: int, raw: str = "channel_raw", normalized: str = "channel_norm") -> DataFrame:
    return label_variants(df, raw, normalized).limit(k)
