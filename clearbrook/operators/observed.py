"""Contracts checked while a load is written.

The rows are counted as they pass on their way to the files, so a load costs one scan, checked or not.  They go to a
folder that no reader knows of; only when every rule holds does it become a version of the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from clearbrook.fixed_values import KEYS
from clearbrook.operators.contracts import ContractViolation, sales_rules
from clearbrook.sources.versions import VersionedTable

_PLACE = "__place_in_key"


@dataclass(frozen=True)
class Load:
    """What a load has counted, and the version it became (None: refused)."""

    n_rows: int
    violations: dict[str, int]
    version: int | None

    @property
    def broken(self) -> dict[str, int]:
        return {rule: n for rule, n in self.violations.items() if n}


def observed_load(
    df: DataFrame, table: VersionedTable, rules: Mapping[str, Column] | None = None, keys: Sequence[str] | None = KEYS,
    tolerated: Mapping[str, int] | None = None, measures: Mapping[str, Column] | None = None,
) -> Load:
    """Write ``df`` as a version of ``table`` if no rule is broken by more rows than ``tolerated``.

    ``keys`` adds the rule ``repeated_rows``: rows whose key has come before,
    NULL parts equal to each other.  It needs the rows by key, which is a
    shuffle, but still no second scan.  ``measures`` are further aggregates
    over the rows, stored with the version.

    The counters sit on top of the plan, next to the write: there each row of
    the result is counted once, whichever tasks had to run again.
    """
    rules = dict(sales_rules() if rules is None else rules)
    tolerated, measures = dict(tolerated or {}), dict(measures or {})
    rows = df
    if keys:
        rows = rows.withColumn(_PLACE, F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))))
        rules["repeated_rows"] = F.col(_PLACE) > 1
    counted = Observation()
    rows = rows.observe(
        counted, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(bad).alias(name) for name, bad in rules.items()],
        *[m.alias(name) for name, m in measures.items()],
    )
    folder = table.stage(rows.drop(_PLACE))
    found = counted.get
    violations = {name: int(found[name]) for name in rules}
    load = Load(int(found["n_rows"]), violations, None)
    if any(n > tolerated.get(rule, 0) for rule, n in load.broken.items()):
        return load
    details = {"n_rows": str(load.n_rows), **{name: str(found[name]) for name in measures}, **{k: str(v) for k, v in load.broken.items()}}
    return Load(load.n_rows, violations, table.publish_staged(folder, details))


def enforce_load(df: DataFrame, table: VersionedTable, **options) -> Load:
    """As :func:`observed_load`, and an error when the load is refused."""
    load = observed_load(df, table, **options)
    if load.version is None:
        raise ContractViolation("; ".join(f"{rule}: {n}" for rule, n in load.broken.items()))
    return load
