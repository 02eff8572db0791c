"""Dedupe, winsorise and relabel in one lazy plan, by a set of rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import (
    CHANNEL_DOMAIN,
    CHANNEL_MAP,
    CHANNEL_MAP_WITHOUT_INSTORE,
    DOCUMENTED_P01,
    DOCUMENTED_P99,
    KEYS,
    P_HIGH,
    P_LOW,
)
from clearbrook.functions.clamps import clamp_null_to_high, clamp_positive, clip, outside
from clearbrook.functions.labels import map_labels, map_labels_or_default
from clearbrook.operators.dedupe import dedupe
from clearbrook.operators.winsor import Clamp, attach_bounds, winsor_bounds

SALES_COLUMNS = ("order_id", "date_parsed", "store_id", "product_id", "unit_price", "quantity", "customer_id")


@dataclass(frozen=True)
class CleaningRules:
    keys: Sequence[str] = KEYS
    order: str = "payload"
    null_keys: str = "collapse"
    low: float = P_LOW
    high: float = P_HIGH
    population: str = "positive"
    fixed_bounds: tuple[float, float] | None = None
    clamp: Clamp = clamp_positive
    label_map: Mapping[str, Sequence[str]] | None = field(default_factory=lambda: CHANNEL_MAP)
    domain: Sequence[str] = CHANNEL_DOMAIN
    label_output: str = "channel"
    keep_raw_label: bool = True
    audit_flags: bool = True
    only_positive_prices: bool = False
    method: str = "distributed"


REFERENCE_RULES = CleaningRules()
AGENT_RULES = CleaningRules(
    order="any",
    fixed_bounds=(DOCUMENTED_P01, DOCUMENTED_P99),
    clamp=clip,
    label_map=CHANNEL_MAP_WITHOUT_INSTORE,
    label_output="channel_norm",
    audit_flags=False,
    only_positive_prices=True,
)
LEGACY_RULES = CleaningRules(
    order="hash",
    clamp=clamp_null_to_high,
    label_map=None,
    label_output="channel_norm",
    keep_raw_label=False,
    audit_flags=False,
)


def with_rules(rules: CleaningRules = REFERENCE_RULES, **changes) -> CleaningRules:
    return replace(rules, **changes)


def audit_flags(low: Column, high: Column, domain: Sequence[str] = CHANNEL_DOMAIN) -> list[Column]:
    """What a cleaning changes: the price, the label (NULL for a missing label)."""
    return [
        outside("unit_price", low, high).alias("was_winsorized"),
        (~F.col("channel_norm").isin(*domain)).alias("was_relabeled"),
    ]


def clean(df: DataFrame, rules: CleaningRules = REFERENCE_RULES) -> DataFrame:
    """Staged rows to clean rows.

    Bounds are measured on all staged rows, duplicates included.  Missing
    customers stay NULL.  Without ``label_map`` unknown labels fall into the
    default bucket, otherwise they become NULL and stay visible.
    """
    kept = dedupe(df, rules.keys, rules.order, rules.null_keys)
    if rules.fixed_bounds:
        low, high = (F.lit(float(b)) for b in rules.fixed_bounds)
    else:
        bounds = winsor_bounds(df, "unit_price", rules.low, rules.high, rules.population, method=rules.method)
        kept = attach_bounds(kept, bounds)
        low, high = F.col("__bounds.p01"), F.col("__bounds.p99")

    if rules.label_map is None:
        label = map_labels_or_default("channel_norm", "channel_raw", rules.domain)
    else:
        label = map_labels("channel_norm", rules.label_map)

    outputs = [
        rules.clamp(F.col(c), low, high).alias(c) if c == "unit_price" else F.col(c) for c in SALES_COLUMNS
    ]
    outputs.append(label.alias(rules.label_output))
    if rules.keep_raw_label:
        outputs.append(F.col("channel_raw"))
    if rules.audit_flags:
        outputs += audit_flags(low, high, rules.domain)
    cleaned = kept.select(*outputs)
    return cleaned.where(F.col("unit_price") > 0) if rules.only_positive_prices else cleaned


def audit_flag_totals(cleaned: DataFrame) -> DataFrame:
    return cleaned.agg(
        F.count_if("was_winsorized").alias("n_winsorized"), F.count_if("was_relabeled").alias("n_relabeled")
    )
