"""Data-quality analysis and remediation on Spark DataFrames."""

from clearbrook.functions.artifacts import artifact_violations, extract_json, sanitize, strip_fences
from clearbrook.functions.sqltext import audit_one, audit_sql
from clearbrook.operators.clean import AGENT_RULES, LEGACY_RULES, REFERENCE_RULES, CleaningRules, clean, with_rules
from clearbrook.operators.compare import before_after_long, before_after_wide
from clearbrook.operators.contracts import contract_violations, enforce_contract, idempotent_append
from clearbrook.operators.dedupe import dedupe
from clearbrook.operators.diff import row_diff
from clearbrook.operators.drift import label_drift, label_off_domain, label_variants
from clearbrook.operators.gates import decision, gate_report, gates
from clearbrook.operators.grouped import apply_by_group
from clearbrook.operators.merge import merge_history
from clearbrook.operators.observed import enforce_load, observed_load
from clearbrook.operators.profile import baseline_checks, table_metrics
from clearbrook.operators.quantiles import exact_quantiles
from clearbrook.operators.sandbox import dry_run, first_viable, readonly_query, readonly_records
from clearbrook.operators.seasonality import classify_days, seasonality, seasonality_flags
from clearbrook.operators.staging import stage_sales
from clearbrook.operators.winsor import (
    outliers_vs_median,
    percentile_drift,
    trim_outliers,
    winsor_bounds,
    winsorize,
    winsorize_by_group,
)
from clearbrook.plans.evidence import evidence_tables
from clearbrook.plans.workflow import apply_patch, run_workflow
from clearbrook.sources.files import read_bundled_artifacts, read_text_artifacts, write_bundled_artifacts
from clearbrook.sources.ingest import ingest, load_raw, stage_table
from clearbrook.sources.versions import VersionedTable
