"""Guardrails, dry run, gates, approval and promotion."""

import pytest
from pyspark.sql import functions as F

from clearbrook.fixed_values import DECISION_APPROVED, DECISION_REVIEW, GATE_P99
from clearbrook.functions.sqltext import audit_one
from clearbrook.operators.clean import clean
from clearbrook.operators.compare import before_after_long, before_after_wide, formatted
from clearbrook.operators.gates import decision, gate_report, gates
from clearbrook.operators.profile import metrics_nonnull_price, table_metrics
from clearbrook.operators.publish import ensure_databases, promote, require_table, snapshot_csv, write_table
from clearbrook.operators.sandbox import SANDBOX_DATABASE, dry_run, first_viable, patch_frame, readonly_query, readonly_records, sample_rows
from clearbrook.plans import catalog
from clearbrook.plans.catalog import BROKEN_PATCH_SQL, INSERT_PATCH_SQL, PATCH_SQL
from clearbrook.plans.workflow import METRICS_SCHEMA, apply_patch, judge, metrics_frame, run_workflow
from clearbrook.sources.sales import sales_raw, sales_staged


@pytest.fixture(scope="module")
def staged(spark, folder):
    frame = sales_staged(spark, folder, closed=True).persist()
    yield frame
    frame.unpersist()


def left_over(spark):
    if not spark.catalog.databaseExists(SANDBOX_DATABASE):
        return []
    return [t.name for t in spark.catalog.listTables(SANDBOX_DATABASE) if not t.isTemporary]


# --- static guardrails --------------------------------------------------------


def test_good_patch_is_safe_and_complete(spark):
    audit = audit_one(spark, PATCH_SQL)
    assert audit["safe"] and not audit["missing_requirements"] and not audit["blocked_commands"]


def test_destructive_statements_are_blocked(spark):
    audit = audit_one(spark, "drop view stg.returns;\nUPDATE raw.visits SET quantity = 2")
    assert audit["blocked_commands"] == ["DROP em raw/stg", "UPDATE em raw/stg"] and not audit["safe"]


def test_invented_columns_are_named(spark):
    audit = audit_one(spark, "SELECT store_id, channel, min(created_at) FROM stg.sales GROUP BY ALL")
    assert audit["unknown_columns"] == ["created_at", "channel (na staging use channel_norm ou channel_raw)"]


@pytest.mark.parametrize(
    "sql, blocked",
    [
        ("SELECT channel_norm AS channel FROM stg.sales", []), ("SELECT payload FROM stg.sales", []),
        ("-- load it", ["comando fora do escopo"]), ("COPY (SELECT 1) TO '/tmp/x'", ["comando fora do escopo"]),
        ("COPY t TO 'x'", []), ("ALTER SCHEMA raw.x", ["ALTER em raw/stg"]), ("DELETE\n FROM\tstg.sales", ["DELETE em raw/stg"]),
        ("CREATE OR REPLACE VIEW raw.v AS SELECT 1", ["CREATE em raw/stg"]), ("CREATE TABLE gold.x AS SELECT * FROM stg.sales", []),
        ("DROP TABLE IF EXISTS raw.x", []), ("xDROP TABLE raw.x", []), ("éDROP TABLE raw.x", []),
    ],
)
def test_blocked_commands(spark, sql, blocked):
    assert audit_one(spark, sql)["blocked_commands"] == blocked


def test_strict_rules_close_the_holes(spark):
    for sql in ("DROP TABLE IF EXISTS raw.x", "TRUNCATE TABLE stg.sales", "MERGE INTO raw.sales USING x", "INSERT INTO stg.sales VALUES (1)"):
        assert not audit_one(spark, sql)["blocked_commands"] and audit_one(spark, sql, strict=True)["blocked_commands"]


def test_alias_removal_is_whole_words_only(spark):
    assert audit_one(spark, "SELECT x AS channel_code, s.channel FROM s")["unknown_columns"] == []
    assert audit_one(spark, "SELECT x AS channel, channel FROM s")["unknown_columns"]


# --- dry run ------------------------------------------------------------------


def test_dry_run_measures_and_leaves_nothing(spark, staged):
    run = dry_run(staged, PATCH_SQL)
    assert run.executed and run.error is None, run.error
    assert run.before["dup_est"] == 13 and run.after["dup_est"] == 0 and run.after["n"] == 1000
    assert run.after["n_channel_off_domain"] == 0 and run.after["n_missing_customer"] == run.before["n_missing_customer"]
    assert len(run.sample) == 5 and left_over(spark) == []
    same = dry_run(staged, clean)
    assert {k: round(v, 6) for k, v in same.after.items() if k != "p01"} == {k: round(v, 6) for k, v in run.after.items() if k != "p01"}


def test_sql_patch_keeps_the_rows_of_the_reference(spark):
    """Of rows with one key both keep the first by content, where nothing comes before something and counts as zero."""
    rows = [
        ("1", "S0", "P0", 5.0, 1, "C1", "online", "online"), ("1", "S0", "P0", 5.0, 1, None, "online", "online"),
        ("2", "S0", "P0", 5.0, 1, "C1", "online", "online"), ("2", "S0", "P0", 5.0, 1, "C1", None, None),
        ("3", "S0", "P0", -5.0, 1, "C1", "online", "online"), ("3", "S0", "P0", None, 1, "C1", "online", "online"),
        ("4", "S0", "P0", 5.0, -1, "C1", "online", "online"), ("4", "S0", "P0", 5.0, None, "C1", "online", "online"),
    ]
    schema = "order_id string, store_id string, product_id string, unit_price double, quantity int, customer_id string, channel_norm string, channel_raw string"
    doubled = spark.createDataFrame(rows, schema).withColumn("date_parsed", F.lit("2024-01-05").cast("date"))
    columns = ["order_id", "unit_price", "quantity", "customer_id", "channel"]
    patched, cleaned = (df.select(columns).orderBy("order_id").collect() for df in (patch_frame(doubled, PATCH_SQL), clean(doubled)))
    assert patched == cleaned and patched[0]["customer_id"] is None and patched[1]["channel"] is None


@pytest.mark.parametrize("patch", [BROKEN_PATCH_SQL, INSERT_PATCH_SQL, "DELETE FROM gold.sales_clean", "SELECT 1; SELECT 2", "CREATE OR REPLACE TABLE gold.other AS SELECT 1"])
def test_errors_are_values(spark, staged, patch):
    run = dry_run(staged, patch)
    assert not run.executed and run.error and run.after is None and left_over(spark) == []


def test_errors_of_single_rows_are_found(spark, staged):
    run = dry_run(staged, "SELECT *, CAST(channel_raw AS INT) AS never_read FROM stg.sales")
    assert not run.executed and "CAST_INVALID_INPUT" in run.error and left_over(spark) == []


def test_blocked_patch_never_runs(staged):
    run = dry_run(staged, "DROP TABLE stg.sales; " + PATCH_SQL)
    assert run.error == "guardrail" and run.before is None
    report = apply_patch(staged, "DROP TABLE stg.sales", approve=True)
    assert report["decision"] == DECISION_REVIEW and not report["applied"] and report["blocked_commands"]


def test_first_viable_keeps_reasons(spark, staged):
    choice = first_viable(staged, [("a", None), ("b", BROKEN_PATCH_SQL), ("c", clean), ("d", clean)])
    assert choice.name == "c" and choice.rejected["a"] == "missing" and "no_such_column" in choice.rejected["b"]
    assert first_viable(staged, [("b", BROKEN_PATCH_SQL)]).name is None


# --- ad-hoc reads -------------------------------------------------------------


def test_readonly_query(spark, staged):
    tables = {"stg.sales": staged}
    rows = readonly_query(spark, "select order_id from stg.sales order by order_id -- last line", tables).collect()
    assert len(rows) == 50 and [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert "error" in readonly_records(spark, "DROP TABLE x")
    assert "error" in readonly_records(spark, "SELECT nothing FROM stg.sales", tables)
    assert len(readonly_records(spark, "WITH a AS (SELECT 1 AS x) SELECT * FROM a;")["rows"]) == 1


def test_a_query_that_writes_is_refused(spark, staged):
    ensure_databases(spark, "guard")
    write_table(spark.range(1), "guard.t")
    assert "error" in readonly_records(spark, "WITH a AS (SELECT 5L AS id) INSERT INTO guard.t SELECT * FROM a")
    assert "error" in readonly_records(spark, "SELECT 1) ; DROP TABLE guard.t; SELECT (1")
    assert spark.table("guard.t").count() == 1


def test_sample_is_ordered(staged):
    rows = sample_rows(staged, 3, ["order_id", "date_parsed"]).collect()
    everything = sorted(r["order_id"] for r in staged.select("order_id").collect() if r["order_id"] is not None)
    assert [r["order_id"] for r in rows] == everything[:3]


# --- gates --------------------------------------------------------------------

BEFORE = dict(n=100, dup_est=5, n_price_zero_or_null=3, n_missing_customer=4, n_channel_labels=6, n_channel_off_domain=30, p01=1.0, p99=200.0)
GOOD = dict(BEFORE, n=80, dup_est=0, n_channel_off_domain=0, n_channel_labels=3)


@pytest.mark.parametrize(
    "change, failed",
    [
        ({}, None), ({"dup_est": 1}, "dedupe_zerou_duplicatas"), ({"p99": 200.0 + 5e-10}, None), ({"p99": 200.1}, "p99_nao_aumentou"),
        ({"n_channel_off_domain": 1}, "canal_dentro_do_dominio"), ({"n_missing_customer": 0}, "customer_id_nao_inventado"),
        ({"n": 79}, "perda_de_linhas_aceitavel"), ({"n": 120}, None), ({"p99": None}, None),
    ],
)
def test_each_gate(spark, change, failed):
    verdict = judge(spark, BEFORE, {**GOOD, **change})
    assert [k for k, ok in verdict["checks"].items() if not ok] == ([failed] if failed else [])
    assert verdict["ok"] is (failed is None)


def test_gates_on_empty_and_strict(spark):
    empty = dict.fromkeys(BEFORE, 0) | {"p01": None, "p99": None}
    verdict = judge(spark, empty, empty)
    assert verdict["ok"] and verdict["drop_ratio"] == 0.0
    half_filled = {**GOOD, "n": 100, "n_missing_customer": 2}
    assert judge(spark, BEFORE, half_filled)["ok"] and not judge(spark, BEFORE, half_filled, strict=True)["ok"]


def test_reports_from_gates(spark):
    row = gates(metrics_frame(spark, BEFORE), metrics_frame(spark, {**GOOD, "dup_est": 2}))
    assert decision(row).first()["decision"] == DECISION_REVIEW
    report = gate_report(row).collect()
    assert len(report) == 5 and {r["loss"] for r in report} == {"20.00%"} and sum(r["passed"] for r in report) == 4
    with pytest.raises(ValueError):
        gates(metrics_frame(spark, BEFORE), metrics_frame(spark, GOOD), "other")


def test_before_after_tables(spark):
    before, after = metrics_frame(spark, {**BEFORE, "n": 12345}), metrics_frame(spark, {**GOOD, "p01": None})
    long = {r["metric"]: r for r in before_after_long(before, after).collect()}
    assert long["n"]["delta"] == -12265.0 and long["p01"]["delta"] is None and list(long)[0] == "n"
    text = {r["label"]: r for r in formatted(before_after_long(before, after)).collect()}
    assert tuple(text["Linhas"])[1:] == ("12,345", "80", "-12,265")
    assert tuple(text["P01 de `unit_price`"])[1:] == ("1.00", "—", "—") and text["P99 de `unit_price`"]["delta"] == "+0.00"
    short = ["n", "dup_est", "p01", "p99"]
    wide = before_after_wide(metrics_frame(spark, {**BEFORE, "n": 0}).select(short), after.select(short)).first()
    assert wide["n_pct_delta"] is None and wide["dup_delta"] == -5 and len(wide) == 13


# --- approval and promotion ---------------------------------------------------


def test_nothing_is_applied_without_approval(spark, staged):
    report = apply_patch(staged, clean, "approval.sales_clean")
    assert report["decision"] == DECISION_APPROVED and not report["applied"]
    assert not spark.catalog.databaseExists("approval")


def test_failed_gates_stop_an_approved_patch_unless_forced(spark, folder):
    open_labels = sales_staged(spark, folder).persist()
    report = apply_patch(open_labels, clean, "forced.sales_clean", approve=True)
    assert report["decision"] == DECISION_REVIEW and not report["applied"]
    assert [t.name for t in spark.catalog.listTables("forced") if not t.isTemporary] == []
    report = apply_patch(open_labels, clean, "forced.sales_clean", approve=True, force=True)
    assert report["applied"] and report["forced"] and spark.table("forced.sales_clean").count() == open_labels.select("order_id", "date_parsed").distinct().count()
    open_labels.unpersist()


def test_apply_keeps_a_backup_and_a_snapshot(spark, staged, tmp_path):
    target = "applied.sales_clean"
    ensure_databases(spark, "applied")
    write_table(spark.range(3), target)
    report = apply_patch(staged, clean, target, approve=True, snapshot=str(tmp_path / "snapshot"))
    assert report["applied"] and not report["forced"]
    assert report["before_after"]["gold_real"] == report["before_after"]["gold_simulated"]
    assert require_table(spark, f"{target}_backup").count() == 3 and spark.table(target).count() == 1000
    assert spark.read.option("header", True).csv(report["snapshot"]).count() == 1000
    again = apply_patch(staged, clean, target, approve=True)
    assert again["applied"] and spark.table(target).count() == 1000 and spark.table(f"{target}_backup").count() == 1000


def test_sql_patch_for_another_target(spark, staged):
    sql = PATCH_SQL.replace("gold.sales_clean", "other.sales_clean")
    report = apply_patch(staged, sql, "other.sales_clean", approve=True)
    assert report["applied"] and report["missing_requirements"] == [] and spark.table("other.sales_clean").count() == 1000


def test_missing_tables_say_what_to_do(spark, tmp_path):
    with pytest.raises(RuntimeError, match="load and stage"):
        require_table(spark, "nowhere.sales")
    with pytest.raises(RuntimeError):
        promote(spark, "nowhere.new", "nowhere.sales")
    with pytest.raises(RuntimeError):
        snapshot_csv(spark, "nowhere.sales", str(tmp_path / "s"))


def test_whole_workflow(spark, folder):
    broken = BROKEN_PATCH_SQL.replace("gold.sales_clean", "flow.sales_clean")
    report = run_workflow(
        sales_raw(spark, folder, closed=True), [("agent", broken)], "flow.sales_clean", approve=True
    )
    assert report["baseline"]["n_rows"] == 1013 and report["applied"] and report["patch"] == "reference"
    assert [(name, chosen) for name, chosen, _ in report["fallback"]] == [("agent", False), ("reference", True)]
    assert report["fallback_notice"]["patch_efetivo"] == "reference" and "no_such_column" in report["fallback_notice"]["motivo"]["agent"]
    assert metrics_nonnull_price(spark.table("flow.sales_clean")).first()["dup_est"] == 0
    assert set(table_metrics(spark.table("flow.sales_clean")).columns) == {f.name for f in METRICS_SCHEMA}


@pytest.mark.parametrize(
    "query",
    [
        "SELECT reflect('java.lang.System', 'setProperty', 'a', 'b')", "SELECT `java_method` ('java.lang.Math', 'abs', -1)",
        "SELECT * FROM parquet.`/root/testdata/sf0.001/region.parquet`", "SELECT * FROM x.stg.sales", "SELECT * FROM other",
        "SELECT (SELECT max(v) FROM other) AS v FROM stg.sales", "WITH a AS (SELECT * FROM other) SELECT * FROM a",
    ],
)
def test_only_given_tables_are_read_and_no_method_called(spark, query):
    tables = {"stg.sales": spark.range(2)}
    assert "error" in readonly_records(spark, query, tables)
    run = dry_run(spark.createDataFrame([], "order_id string, date_parsed date, unit_price double, customer_id string, channel_norm string"), query)
    assert not run.executed and run.error


def test_names_in_strings_and_comments_stay(spark):
    rows = readonly_records(spark, "SELECT 'see stg.sales' AS a, stg.sales.id FROM stg.sales /* stg.sales */ -- stg.sales", {"stg.sales": spark.range(1)})
    assert rows == {"rows": [{"a": "see stg.sales", "id": 0}]}


@pytest.mark.parametrize("problem", [KeyError("x"), AttributeError("y"), RuntimeError("z")])
def test_whatever_a_patch_raises_is_a_value(spark, staged, problem):
    def patch(df):
        raise problem

    run = dry_run(staged, patch)
    assert not run.executed and type(problem).__name__ in run.error


def test_approved_runs_are_applied_where_a_gate_fails(spark, tmp_path):
    """A zero among the tenfold prices, and repeated low ones: the 99th percentile rises above the one before."""
    value = F.when(F.col("id") == 178, 0.0).when(F.col("id") % 2 == 0, 1 + F.col("id") / 1000).otherwise(F.col("id") + 100.0)
    events = spark.range(400).select(
        F.col("id").alias("event_id"), (F.col("id") % 50).alias("user_id"), F.lit("buy").alias("event_type"), value.alias("value"),
        F.lit("2024-01-15 10:00:00").cast("timestamp").alias("ts"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    folder, named = str(tmp_path), catalog.queries()
    passed = {row["gate"]: row["passed"] for row in named["workflow_gates"](spark, folder).collect()}
    assert not passed[GATE_P99]
    assert named["apply_gold_readback"](spark, folder).count() == 400
    tried = named["fallback_notice"](spark, folder).collect()
    assert len(tried) == 3 and all(row["n_rows"] == 400 and row["effective"] == "reference" for row in tried)
    stored = named["workflow_report"](spark, folder).collect()
    assert len(stored) == 24 and all(row["applied"] and row["decision"] == DECISION_REVIEW for row in stored)
