"""From staged rows to an approved table: try, gate, approve, promote, re-measure."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clearbrook.fixed_values import DECISION_APPROVED, DECISION_REVIEW, GOLD_TABLE, STAGING_TABLE
from clearbrook.operators.clean import clean
from clearbrook.operators.gates import gates
from clearbrook.operators.profile import baseline_checks, table_metrics
from clearbrook.operators.publish import ensure_databases, promote, snapshot_csv
from clearbrook.operators.sandbox import DryRun, Patch, dry_run, first_viable
from clearbrook.operators.staging import stage_sales
from clearbrook.plans.reports import append_report

METRICS_SCHEMA = T.StructType(
    [
        T.StructField(name, T.LongType())
        for name in ("n", "dup_est", "n_price_zero_or_null", "n_missing_customer", "n_channel_labels", "n_channel_off_domain")
    ]
    + [T.StructField("p01", T.DoubleType()), T.StructField("p99", T.DoubleType())]
)


def metrics_frame(spark: SparkSession, record: dict) -> DataFrame:
    """A measured record as a one-row frame again."""
    return spark.createDataFrame([tuple(record[f.name] for f in METRICS_SCHEMA)], METRICS_SCHEMA)


def judge(spark: SparkSession, before: dict, after: dict, **options) -> dict:
    row = gates(metrics_frame(spark, before), metrics_frame(spark, after), **options).first().asDict()
    ratio, ok = row.pop("drop_ratio"), row.pop("ok")
    return {"drop_ratio": ratio, "checks": row, "ok": ok}


def apply_patch(
    staged: DataFrame, patch: Patch, target: str = GOLD_TABLE, source: str = STAGING_TABLE,
    approve: bool = False, force: bool = False, strict: bool = False, snapshot: str | None = None,
    name: str = "patch", run: DryRun | None = None,
) -> dict:
    """Dry run, gates, and with ``approve`` the promotion of the measured rows.

    ``target`` changes only with ``approve`` and either all gates or ``force``.
    The sandbox table that was measured is what gets promoted, so a large
    patch is computed once and nothing unmeasured is published.
    """
    spark = staged.sparkSession
    new = f"{target}_new"
    if run is None or (approve and run.executed and not run.table):  # a run that kept no table has nothing to promote
        if approve:
            ensure_databases(spark, target.split(".")[0])
        run = dry_run(staged, patch, source, target, strict, keep=new if approve else None)
    report = {
        "timestamp": datetime.now(timezone.utc).isoformat(),
        "patch": name,
        "syntax_ok": run.executed,
        "execution_error": run.error,
        "blocked_commands": run.guard["blocked_commands"],
        "missing_requirements": run.guard["missing_requirements"],
        "unknown_columns": run.guard["unknown_columns"],
        "before_after": run.metrics(),
        "applied": False,
        "forced": False,
        "require_human_approval": True,
        "gates": None,
        "decision": DECISION_REVIEW,
    }
    if not run.executed:
        return {**report, "notes": f"the patch did not run; nothing was changed: {run.error}"}

    report["gates"] = judge(spark, run.before, run.after, strict=strict)
    passed = report["gates"]["ok"]
    report["decision"] = DECISION_APPROVED if passed else DECISION_REVIEW
    if not approve or not (passed or force):
        if run.table:
            spark.sql(f"DROP TABLE IF EXISTS {run.table}")
        why = "not approved yet" if not approve else "approved, but gates failed; force overrides them"
        return {**report, "notes": why}

    gold = promote(spark, run.table, target)
    report["before_after"]["gold_real"] = table_metrics(gold).first().asDict()
    if snapshot:
        report["snapshot"] = snapshot_csv(spark, target, snapshot)
    return {**report, "applied": True, "forced": not passed, "notes": "applied after explicit approval"}


def run_workflow(
    raw: DataFrame, candidates: Sequence[tuple[str, Patch | None]] = (), target: str = GOLD_TABLE,
    approve: bool = False, force: bool = False, history: str | None = None, **options,
) -> dict:
    """Stage, measure, try the candidates in order with :func:`clean` last, apply the first that runs.

    With ``history``, a path, the report is appended to the runs stored there, whatever came of it, and has its
    ``run_id``.
    """
    spark = raw.sparkSession
    staged = stage_sales(raw)
    keep = None
    if approve:
        ensure_databases(spark, target.split(".")[0])
        keep = f"{target}_new"
    choice = first_viable(staged, [*candidates, ("reference", clean)], target=target, keep=keep)
    patch = dict([*candidates, ("reference", clean)]).get(choice.name, clean)
    run = choice.run or DryRun(False, "no candidate ran", {k: [] for k in ("blocked_commands", "missing_requirements", "unknown_columns")})
    report = apply_patch(
        staged, patch, target, approve=approve, force=force, name=choice.name or "none", run=run, **options
    )
    report = {
        "baseline": baseline_checks(staged).first().asDict(),
        "fallback": choice.records(),
        "fallback_notice": choice.notice(),
        **report,
    }
    return report | {"run_id": append_report(spark, history, report)} if history else report
