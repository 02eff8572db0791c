"""One row per key.

``row_number() = 1`` lets the optimizer keep one row per key on the map side
before the shuffle, so a key held by a third of the rows sends one row per
input task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbrook.fixed_values import KEYS
from clearbrook.functions.scalars import missing_safe_number, missing_safe_text


def payload_order() -> list[Column]:
    """Total order of sales rows by content, NULLs last."""
    columns = [
        F.col("store_id"), F.col("product_id"), missing_safe_text("customer_id"), missing_safe_text("channel_raw"),
        missing_safe_number("unit_price"), missing_safe_number("quantity"),
    ]
    return [c.asc_nulls_last() for c in columns]


def hash_order() -> list[Column]:
    """Order by a hash of the content; rows that tie are the same row."""
    columns = [F.col(c) for c in ("order_id", "store_id", "product_id")]
    columns += [missing_safe_text(c) for c in ("customer_id", "channel_norm", "channel_raw")]
    columns += [missing_safe_number(c).cast("string") for c in ("unit_price", "quantity")]
    return [F.xxhash64(*columns).asc()]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def dedupe(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    order: str | Sequence[Column] = "payload",
    null_keys: str = "collapse",
) -> DataFrame:
    """Keep one row per key.

    ``order`` is ``payload`` (by content), ``hash``, ``any`` (whichever row
    comes, no sort) or a list of sort columns.  NULL key parts are equal to
    each other unless ``null_keys="keep"`` lets incomplete keys pass untouched.
    """
    if null_keys == "keep":
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        return dedupe(df.where(complete), keys, order).unionByName(df.where(~complete))
    if order == "any":
        return df.dropDuplicates(list(keys))
    if isinstance(order, str):
        order = {"payload": payload_order, "hash": hash_order}[order]()
    return keep_first(df, keys, order)
