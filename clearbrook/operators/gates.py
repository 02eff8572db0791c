"""Acceptance gates over the metrics of both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import (
    DECISION_APPROVED,
    DECISION_REVIEW,
    GATE_CHANNEL,
    GATE_CUSTOMER,
    GATE_DEDUPE,
    GATE_P99,
    GATE_ROW_LOSS,
    LEGACY_GATE_DEDUPE,
    LEGACY_GATE_P99,
    LEGACY_GATE_ROW_LOSS,
    MAX_DROP_RATIO,
    P99_TOLERANCE,
)
from clearbrook.operators.compare import side_by_side

GATES = (GATE_DEDUPE, GATE_P99, GATE_CHANNEL, GATE_CUSTOMER, GATE_ROW_LOSS)
LEGACY_GATES = (LEGACY_GATE_DEDUPE, LEGACY_GATE_P99, LEGACY_GATE_ROW_LOSS)


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def drop_ratio() -> Column:
    """Share of rows lost, never below zero; zero for an empty table."""
    before = F.nullif(_zero("n_before").cast("double"), F.lit(0.0))
    return F.coalesce(F.greatest(F.lit(0.0), (before - _zero("n_after")) / before), F.lit(0.0))


def gates(
    before: DataFrame, after: DataFrame, profile: str = "reference", max_drop_ratio: float = MAX_DROP_RATIO,
    strict: bool = False,
) -> DataFrame:
    """One row: the drop ratio, one boolean per gate, and ``ok`` when all hold.

    ``strict`` also asks that no missing customer was filled in: the share of
    rows without one may not fall.
    """
    no_duplicates = _zero("dup_est_after") <= 0
    little_loss = drop_ratio() <= max_drop_ratio
    if profile == "legacy":
        checks = {
            LEGACY_GATE_DEDUPE: no_duplicates,
            LEGACY_GATE_P99: _zero("p99_after") <= _zero("p99_before"),
            LEGACY_GATE_ROW_LOSS: little_loss,
        }
    elif profile == "reference":
        missing_before, missing_after = _zero("n_missing_customer_before"), _zero("n_missing_customer_after")
        customers = (missing_after > 0) | (missing_before == 0)
        if strict:
            customers = missing_after * _zero("n_before") >= missing_before * _zero("n_after")
        checks = {
            GATE_DEDUPE: no_duplicates,
            GATE_P99: _zero("p99_after") <= _zero("p99_before") + P99_TOLERANCE,
            GATE_CHANNEL: _zero("n_channel_off_domain_after") == 0,
            GATE_CUSTOMER: customers,
            GATE_ROW_LOSS: little_loss,
        }
    else:
        raise ValueError(f"unknown profile: {profile}")
    results = side_by_side(before, after).select(
        F.round(drop_ratio(), 4).alias("drop_ratio"), *[c.alias(name) for name, c in checks.items()]
    )
    all_hold = F.forall(F.array(*checks), lambda passed: passed)
    return results.withColumn("ok", all_hold)


def decision(gate_row: DataFrame) -> DataFrame:
    verdict = F.when(F.col("ok"), DECISION_APPROVED).otherwise(DECISION_REVIEW)
    return gate_row.select("drop_ratio", "ok", verdict.alias("decision"))


def gate_report(gate_row: DataFrame) -> DataFrame:
    """One row per gate, with the row loss in percent."""
    names = [c for c in gate_row.columns if c not in ("drop_ratio", "ok")]
    rows = F.array(*[F.struct(F.lit(n).alias("gate"), F.col(n).alias("passed")) for n in names])
    loss = F.format_string("%.2f%%", F.col("drop_ratio") * 100).alias("loss")
    return gate_row.select(F.inline(rows), loss)
