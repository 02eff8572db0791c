"""Label maps as expressions, and as a join for wide maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import CHANNEL_DEFAULT, CHANNEL_DOMAIN, CHANNEL_MAP
from clearbrook.functions.scalars import as_column, normalize_label


def map_labels(
    value: Column | str,
    mapping: Mapping[str, Sequence[str]] = CHANNEL_MAP,
    unknown: str | None = None,
) -> Column:
    """Spelling to label; spellings nobody listed become ``unknown``."""
    value = as_column(value)
    arms = [F.when(value.isin(*spellings), F.lit(label)) for label, spellings in mapping.items()]
    return F.coalesce(*arms, F.lit(unknown).cast("string"))


def map_labels_or_default(
    normalized: Column | str,
    raw: Column | str,
    domain: Sequence[str] = CHANNEL_DOMAIN,
    default: str = CHANNEL_DEFAULT,
) -> Column:
    """In-domain label kept, else the raw one normalised, else the default."""
    tries = [as_column(normalized), normalize_label(raw)]
    return F.coalesce(*[F.when(t.isin(*domain), t) for t in tries], F.lit(default))


def map_labels_by_table(df: DataFrame, column: str, pairs: DataFrame, output: str) -> DataFrame:
    """Left join to a (spelling, label) table, for maps too wide for an expression.

    No broadcast is forced: adaptive execution measures the map and chooses.
    One row per spelling is made sure of, so rows of ``df`` never multiply.
    """
    unique = pairs.groupBy(F.col("spelling").alias(column)).agg(F.min("label").alias(output))
    return df.join(unique, column, "left")
