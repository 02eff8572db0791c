"""Checks as contracts of a load, and loads that can be repeated safely."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.fixed_values import CHANNEL_DOMAIN, KEYS
from clearbrook.functions.scalars import not_positive, off_domain
from clearbrook.operators.dedupe import dedupe
from clearbrook.operators.joins import one_row
from clearbrook.operators.profile import duplicate_summary


class ContractViolation(ValueError):
    """A load that breaks at least one rule."""


def sales_rules() -> dict[str, Column]:
    """Row rules: each names rows that must not occur."""
    return {
        "date_missing": F.col("date_parsed").isNull(),
        "label_off_domain": off_domain("channel_norm", CHANNEL_DOMAIN),
        "price_not_positive": not_positive("unit_price"),
        "quantity_not_positive": not_positive("quantity"),
    }


def contract_violations(
    df: DataFrame, rules: Mapping[str, Column] | None = None, keys: Sequence[str] | None = KEYS
) -> DataFrame:
    """One row per rule: how many rows break it and whether it holds.

    All row rules are counted in one pass; ``keys`` adds the rule that no
    complete or incomplete key repeats.
    """
    rules = sales_rules() if rules is None else rules
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    names = list(rules)
    if keys:
        counts = one_row(counts, duplicate_summary(df, keys).select(F.col("n_dup_pairs").alias("duplicate_keys")))
        names.append("duplicate_keys")
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names])
    return counts.select(F.inline(rows)).withColumn("holds", F.col("violations") == 0)


def enforce_contract(df: DataFrame, rules: Mapping[str, Column] | None = None, keys: Sequence[str] | None = KEYS) -> None:
    """Raise when a rule is broken; one row per rule reaches the driver."""
    broken = contract_violations(df, rules, keys).where(~F.col("holds")).collect()
    if broken:
        raise ContractViolation("; ".join(f"{r['rule']}: {r['violations']}" for r in broken))


def new_rows(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str] = KEYS, range_key: str | None = "date_parsed",
    order: str | Sequence[Column] = "payload",
) -> DataFrame:
    """Rows of a batch that are not loaded yet: one per complete key, and rows with an incomplete key by content.

    Both sides are reduced to one row per key before they meet, so no key is
    heavy in the join.  A row with a NULL key part has no key; its whole
    content, NULLs equal to each other, tells whether it is loaded, so loading
    a batch again adds nothing.  Such rows never enter the join on the keys.

    ``range_key`` is a key column that batches cover only a stretch of, such as
    the day: existing rows outside the batch's stretch cannot match and are
    left out.  Where the history is partitioned by that column the scan skips
    whole partitions, and a load costs what the batch costs.  ``order`` is that
    of :func:`dedupe`.
    """
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    keyed, loaded = batch.where(complete), existing.where(complete)
    if range_key in keys:
        span = batch.agg(F.struct(F.min(range_key).alias("first"), F.max(range_key).alias("last"))).scalar()
        loaded = loaded.where(F.col(range_key).between(span["first"], span["last"]))
    fresh = dedupe(keyed, keys, order).join(loaded.select(*keys).distinct(), list(keys), "left_anti").select(*batch.columns)
    unkeyed = batch.where(~complete).subtract(existing.where(~complete).select(*batch.columns))
    return fresh.unionByName(unkeyed)


def idempotent_append(
    existing: DataFrame, batch: DataFrame, keys: Sequence[str] = KEYS, range_key: str | None = "date_parsed"
) -> DataFrame:
    """Existing rows and the new ones; loading a batch twice changes nothing.

    A caller with a stored history appends :func:`new_rows` to it instead of writing all of this again.
    """
    return existing.unionByName(new_rows(existing, batch, keys, range_key).select(*existing.columns))
