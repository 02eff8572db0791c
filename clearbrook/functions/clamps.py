"""Ways to pull a value back into ``[low, high]``; they differ on NULL and <= 0."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clearbrook.functions.scalars import as_column


def clip(value: Column | str, low: Column, high: Column) -> Column:
    """NULL stays NULL; NaN stays NaN; a missing bound leaves the value alone."""
    value = as_column(value)
    return F.when(F.isnan(value.cast("double")), value).when(value < low, low).when(value > high, high).otherwise(value)


def clamp_positive(value: Column | str, low: Column, high: Column) -> Column:
    """As :func:`clip`, and everything not above zero becomes the lower bound."""
    value = as_column(value)
    return F.when((value <= 0) | (value < low), low).when(value > high, high).otherwise(value)


def clamp_null_to_high(value: Column | str, low: Column, high: Column) -> Column:
    """GREATEST/LEAST skip NULL arguments, so a missing value becomes ``high``."""
    return F.greatest(F.least(as_column(value), high), low)


def outside(value: Column | str, low: Column, high: Column) -> Column:
    """True when a non-NULL value lies outside the bounds; FALSE for NULL values."""
    value = as_column(value)
    return value.isNotNull() & ((value < low) | (value > high))
