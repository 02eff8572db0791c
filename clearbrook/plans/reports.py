"""History of workflow runs: one stored record per run, never changed, and the tables that are read from it."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_SCHEMA = (
    "run_id string, at string, patch string, syntax_ok boolean, execution_error string, applied boolean, forced boolean, "
    "decision string, drop_ratio double, checks map<string,boolean>, "
    "metrics array<struct<stage:string,metric:string,value:double>>, blocked_commands array<string>, "
    "missing_requirements array<string>, unknown_columns array<string>, "
    "candidates array<struct<candidate:string,chosen:boolean,reason:string>>, fallback_notice string, notes string"
)


def report_record(report: dict, run_id: str | None = None) -> tuple:
    """A report of :func:`apply_patch` or :func:`run_workflow` as a row of the history."""
    gates = report.get("gates") or {}
    metrics = [
        (stage, metric, None if value is None else float(value))
        for stage, record in (report.get("before_after") or {}).items() for metric, value in (record or {}).items()
    ]
    notice = report.get("fallback_notice")
    return (
        run_id or uuid.uuid4().hex, report.get("timestamp") or datetime.now(timezone.utc).isoformat(), report.get("patch"),
        report.get("syntax_ok"), report.get("execution_error"), report.get("applied"), report.get("forced"), report.get("decision"),
        gates.get("drop_ratio"), gates.get("checks"), metrics, report.get("blocked_commands"), report.get("missing_requirements"),
        report.get("unknown_columns"), [tuple(c) for c in report.get("fallback", [])],
        json.dumps(notice, ensure_ascii=False) if notice else None, report.get("notes"),
    )


def append_report(spark: SparkSession, path: str, report: dict, run_id: str | None = None) -> str:
    """Add a run to the history below ``path``; returns its id.  Runs that end at the same time do not meet."""
    record = report_record(report, run_id)
    spark.createDataFrame([record], REPORT_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return record[0]


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).parquet(path)


def latest_report(reports: DataFrame) -> DataFrame:
    """The record of the run that ended last; one row, or none."""
    last = reports.agg(F.max_by(F.struct(*reports.columns), F.struct("at", "run_id")).alias("r"))
    return last.where("r IS NOT NULL").select("r.*")


def reported_gates(reports: DataFrame) -> DataFrame:
    return reports.select("run_id", F.explode("checks").alias("gate", "passed"))


def reported_metrics(reports: DataFrame) -> DataFrame:
    return reports.select("run_id", F.inline("metrics"))


def reported_candidates(reports: DataFrame) -> DataFrame:
    """What was tried in each run, and the patch that took effect according to its notice (NULL: no fallback)."""
    return reports.select("run_id", F.get_json_object("fallback_notice", "$.patch_efetivo").alias("effective"), F.inline("candidates"))


def report_tables(reports: DataFrame) -> dict[str, DataFrame]:
    """The tables of a root-cause report that come from a stored run: nothing is measured again."""
    runs = reports.select("run_id", "at", "patch", "syntax_ok", "applied", "forced", "decision", "drop_ratio", "notes")
    return {
        "run": runs, "run_gates": reported_gates(reports), "run_metrics": reported_metrics(reports),
        "run_candidates": reported_candidates(reports),
    }
