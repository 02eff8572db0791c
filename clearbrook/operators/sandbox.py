"""Trying a patch without touching anything: rewriting, dry run, fallback, ad-hoc reads."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbrook.fixed_values import (
    FALLBACK_REASON_FAILED,
    FALLBACK_REASON_MISSING,
    GOLD_TABLE,
    READONLY_MESSAGE,
    READONLY_ROWS,
    SAMPLE_ROWS,
    STAGING_TABLE,
)
from clearbrook.functions.sqltext import audit_one
from clearbrook.operators.profile import table_metrics
from clearbrook.operators.publish import ensure_databases
from clearbrook.session import scratch_root

SANDBOX_DATABASE = "clearbrook_sandbox"

Transform = Callable[[DataFrame], DataFrame]
Patch = Transform | str


class PatchError(ValueError):
    """A patch text that is not one query or one create-table-as-query."""


#: Parts of a SQL text that hold no names: strings, quoted names, comments.
_QUOTED = r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/"""
#: Functions that call any method of any class by its name.
_CALLS = re.compile(r"\b(?:try_)?(?:reflect|java_method)\s*\(", re.IGNORECASE)


def replace_names(query: str, names: Mapping[str, str]) -> str:
    """Names of tables replaced where they stand as names.

    Strings, quoted names and comments stay, and so does a name that is the
    end of a longer one.
    """
    for name, other in names.items():
        pattern = re.compile(rf"({_QUOTED})|(?<![\w.]){re.escape(name)}(?!\w)", re.IGNORECASE | re.DOTALL)
        query = pattern.sub(lambda m, other=other: m[1] or other, query)
    return query


def _refuse_effects(spark: SparkSession, query: str, allowed: Mapping[str, str]) -> None:
    """Raise unless the query reads the allowed tables only and calls no method by name.

    The text is parsed, not analysed, so nothing of it has run yet.  Relations
    by path (``parquet.`/folder` ``) and tables of the catalog are not allowed
    unless they are given; names that the query defines itself are.
    """
    bare = re.sub(_QUOTED, lambda m: f"{m[0].strip('`')} " if m[0][0] == "`" else " ", query, flags=re.DOTALL)
    if _CALLS.search(bare):
        raise PatchError("calls of methods by name are not allowed")
    tree = spark._jsparkSession.sessionState().sqlParser().parsePlan(query).treeString()
    own = {n.strip().lower() for names in re.findall(r"CTE \[([^\]]*)\]", tree) for n in names.split(",")}
    for relation in re.findall(r"UnresolvedRelation \[([^\]]*)\]", tree):
        if ".".join(relation.split(", ")).lower() not in own | set(allowed):
            raise PatchError(f"reads {relation.replace(', ', '.')}, which is not one of the given tables")


def query_frame(spark: SparkSession, query: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A frame for a SQL text that can only be a query over the given tables.

    The text stands in parentheses, where the grammar allows nothing but a
    query: ``WITH ... INSERT`` or a second statement is a syntax error and
    nothing runs.  Names in ``tables`` mean the given frames; no other table
    or file can be read, and no method called.
    """
    views = {name: f"source_{uuid.uuid4().hex}" for name in tables or {}}
    text = f"SELECT * FROM (\n{replace_names(query, views).strip().rstrip(';')}\n)"
    _refuse_effects(spark, text, {view: name for name, view in views.items()})
    for name, view in views.items():
        tables[name].createOrReplaceTempView(view)
    try:
        return spark.sql(text)
    finally:
        for view in views.values():  # names are resolved already; the frame no longer needs them
            spark.catalog.dropTempView(view)


def patch_frame(
    staged: DataFrame, patch: Patch, source: str = STAGING_TABLE, target: str = GOLD_TABLE,
) -> DataFrame:
    """What a patch would put into ``target``, as a lazy frame.

    A text is a query, or ``CREATE OR REPLACE TABLE <target> AS <query>`` with
    an optional ``CREATE SCHEMA`` before it.  ``quantile_cont`` is read as the
    exact percentile it is.
    """
    if callable(patch):
        return patch(staged)
    lead = r"\A(?:\s|--[^\n]*\n)*"
    query = re.sub(lead + r"CREATE\s+SCHEMA\s+IF\s+NOT\s+EXISTS\s+\w+\s*;", "", patch, flags=re.IGNORECASE)
    created = lead + rf"CREATE\s+(?:OR\s+REPLACE\s+)?TABLE\s+{re.escape(target)}\s+AS\b"
    query, matched = re.subn(created, "", query, flags=re.IGNORECASE)
    if not matched and not re.match(lead + r"(SELECT|WITH)\b", query, re.IGNORECASE):
        raise PatchError(f"expected a query or CREATE OR REPLACE TABLE {target} AS a query")
    query = re.sub(r"\bquantile_cont\s*\(", "percentile(", query, flags=re.IGNORECASE)
    return query_frame(staged.sparkSession, query, {source: staged})


@dataclass
class DryRun:
    executed: bool
    error: str | None
    guard: dict
    before: dict | None = None
    after: dict | None = None
    sample: list[dict] = field(default_factory=list)
    table: str | None = None

    def metrics(self) -> dict:
        return {"stg": self.before, "gold_simulated": self.after}


def dry_run(
    staged: DataFrame, patch: Patch, source: str = STAGING_TABLE, target: str = GOLD_TABLE,
    strict: bool = False, keep: str | None = None,
) -> DryRun:
    """Run a patch against a sandbox table, measure both sides, drop the table.

    The sandbox is really written: every column of every row is evaluated
    once, and the metrics then read only the columns they need.  Errors are
    returned, not raised.  ``keep`` names a table to write instead and leave in
    place, so that the very rows that were measured can be promoted.
    """
    spark = staged.sparkSession
    guard = {"blocked_commands": [], "missing_requirements": [], "unknown_columns": [], "safe": True}
    if isinstance(patch, str):
        guard = audit_one(spark, patch, strict, target)
        if guard["blocked_commands"] or (strict and (not guard["safe"] or guard["missing_requirements"])):
            return DryRun(False, "guardrail", guard)

    before = table_metrics(staged).first().asDict()
    table = keep or f"{SANDBOX_DATABASE}.dry_run_{uuid.uuid4().hex}"
    if not keep:
        ensure_databases(spark, SANDBOX_DATABASE, location=scratch_root(spark))
    done = False
    try:
        patch_frame(staged, patch, source, target).write.mode("overwrite").saveAsTable(table)
        result = spark.table(table)
        after = table_metrics(result).first().asDict()
        sample = [row.asDict() for row in result.limit(SAMPLE_ROWS).collect()]
        done = True
    except Exception as problem:  # whatever a patch does wrong, or the engine under it, is a value for the caller
        return DryRun(False, f"{type(problem).__name__}: {problem}", guard, before)
    finally:
        if not (done and keep):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return DryRun(True, None, guard, before, after, sample, keep)


def simulate_before_after_metrics(staged: DataFrame, patch: Patch, **options) -> dict:
    """Metrics of both sides of a dry run, for callers that need nothing else."""
    return dry_run(staged, patch, **options).metrics()


@dataclass
class Choice:
    name: str | None
    run: DryRun | None
    rejected: dict[str, str]

    def records(self) -> list[tuple[str, bool, str | None]]:
        """(candidate, chosen, reason it was rejected)."""
        rows = [(name, False, reason) for name, reason in self.rejected.items()]
        return rows + ([(self.name, True, None)] if self.name else [])

    def notice(self) -> dict | None:
        """Record of a fallback; None when the first candidate was taken.

        Tells a candidate that was never produced from one that failed.
        """
        if not self.rejected:
            return None
        return {
            "fallback_acionado": True,
            "motivo": {
                name: FALLBACK_REASON_MISSING if reason == "missing" else f"{FALLBACK_REASON_FAILED}: {reason}"
                for name, reason in self.rejected.items()
            },
            "patch_efetivo": self.name,
        }


def first_viable(staged: DataFrame, candidates: Sequence[tuple[str, Patch | None]], **options) -> Choice:
    """The first candidate that runs in the sandbox; why each earlier one did not.

    A candidate without a patch is one that was never produced.
    """
    rejected: dict[str, str] = {}
    for name, patch in candidates:
        if patch is None:
            rejected[name] = "missing"
            continue
        run = dry_run(staged, patch, **options)
        if run.executed:
            return Choice(name, run, rejected)
        rejected[name] = run.error or "failed"
    return Choice(None, None, rejected)


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS, order: Sequence[str] | None = None) -> DataFrame:
    """A few rows to look at; with ``order`` always the same ones, rows without a value last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n) if order else df.limit(n)


def readonly_query(
    spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None, limit: int = READONLY_ROWS
) -> DataFrame:
    """First rows of an ad-hoc query; anything but a query is refused."""
    if not re.match(r"\s*(SELECT|WITH)\b", sql, re.IGNORECASE):
        raise PermissionError(READONLY_MESSAGE)
    return query_frame(spark, sql, tables).limit(limit)


def readonly_records(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame] | None = None) -> dict:
    """As :func:`readonly_query`, with rows or the error as a value."""
    try:
        return {"rows": [row.asDict() for row in readonly_query(spark, sql, tables).collect()]}
    except (PermissionError, PatchError) as refused:
        return {"error": str(refused)}
    except PySparkException as problem:
        return {"error": f"{type(problem).__name__}: {problem}"}
