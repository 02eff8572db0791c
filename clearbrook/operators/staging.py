"""Raw text rows to typed staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbrook.functions.scalars import (
    blank_to_null,
    normalize_label,
    parse_date,
    safe_double,
    safe_int,
)


def stage_sales(raw: DataFrame) -> DataFrame:
    """Lazy staging of raw sales: a projection, so scans stay column-pruned."""
    return raw.select(
        "order_id",
        parse_date("date").alias("date_parsed"),
        "store_id",
        "product_id",
        safe_double("unit_price").alias("unit_price"),
        safe_int("quantity").alias("quantity"),
        blank_to_null("customer_id").alias("customer_id"),
        normalize_label("channel").alias("channel_norm"),
        F.col("channel").alias("channel_raw"),
    )
