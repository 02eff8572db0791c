"""The tables a root-cause report is made of, measured and not estimated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearbrook.operators.compare import before_after_long
from clearbrook.operators.drift import label_drift, label_off_domain, off_domain_total
from clearbrook.operators.gates import gate_report, gates
from clearbrook.operators.profile import table_metrics
from clearbrook.operators.seasonality import classify_days, flagged_days, seasonality, seasonality_flags


def seasonality_block(flags: DataFrame) -> DataFrame:
    """Day, rows, distinct orders, excess rows, deviation in signed percent."""
    percent = F.col("dev_vs_ma7") * 100
    return flags.select("d", "n_rows", "n_orders", "dup_rows_no_dia", F.format_string("%+.1f%%", percent).alias("deviation"))


def evidence_tables(
    staged: DataFrame, cleaned: DataFrame | None, start: str | None = None, end: str | None = None,
    days: Sequence[str] | None = None, calendar: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Tables by name, all from the same two inputs.

    Both are read several times, so give tables that are written (see ``session.written``), not plans. Without
    ``cleaned`` the tables that compare both sides are left out.
    """
    flags = seasonality_flags(seasonality(staged, start, end))
    drift = label_drift(staged)
    shown = flags if days is None else flags.where(F.col("d").isin(*[F.lit(d).cast("date") for d in days]))
    tables = {
        "seasonality": seasonality_block(shown),
        "flagged_days": flagged_days(flags),
        "verdicts": classify_days(flags, calendar),
        "labels": drift,
        "labels_off_domain": label_off_domain(drift),
        "off_domain_total": off_domain_total(drift),
    }
    if cleaned is not None:
        before, after = table_metrics(staged), table_metrics(cleaned)
        tables["before_after"] = before_after_long(before, after)
        tables["gates"] = gate_report(gates(before, after))
    return tables
