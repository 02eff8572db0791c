"""The same results in plain SQL, for another engine over the same tables."""

from __future__ import annotations

from clearbrook.fixed_values import DECISION_APPROVED
from clearbrook.plans.catalog import (
    CORRECTED_DAYS, FIRST_DAY, HOLIDAYS, LAST_DAY, SELECTED_DAYS, SKETCHED, SPLIT_DAY, SQL_TEMPLATES,
)
from clearbrook.sources.sales import SALES_VARIANTS

STAGED = """
  SELECT order_id,
    coalesce(CAST(try_strptime(trim(date), '%Y-%m-%d') AS DATE), CAST(try_strptime(trim(date), '%d/%m/%Y') AS DATE),
             CAST(try_strptime(trim(date), '%Y/%m/%d') AS DATE)) AS date_parsed,
    store_id, product_id, TRY_CAST(unit_price AS DOUBLE) AS unit_price, TRY_CAST(quantity AS INTEGER) AS quantity,
    nullif(trim(customer_id), '') AS customer_id,
    lower(replace(replace(channel, '-', '_'), ' ', '_')) AS channel_norm, channel AS channel_raw
  FROM sales_raw
"""
DOMAIN = "('online', 'in_store', 'marketplace')"

POSITIVE_BOUNDS = """
  bounds AS (SELECT quantile_cont(unit_price, 0.01) AS p01, quantile_cont(unit_price, 0.99) AS p99
             FROM stg WHERE unit_price > 0)"""
NONNULL_BOUNDS = """
  bounds AS (SELECT quantile_cont(unit_price, 0.01) AS p01, quantile_cont(unit_price, 0.99) AS p99
             FROM stg WHERE unit_price IS NOT NULL)"""
P01, P99 = "(SELECT p01 FROM bounds)", "(SELECT p99 FROM bounds)"
PAYLOAD = """
  store_id NULLS LAST, product_id NULLS LAST, coalesce(customer_id, ''), coalesce(channel_raw, ''),
  coalesce(unit_price, 0), coalesce(quantity, 0)"""
KEPT = f"""
  kept AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, date_parsed ORDER BY {PAYLOAD}) AS place FROM stg
  ) AS numbered WHERE place = 1)"""
STRICT_LABEL = """
  CASE WHEN channel_norm IN ('online', 'on_line') THEN 'online'
       WHEN channel_norm IN ('in_store', 'store', 'instore') THEN 'in_store'
       WHEN channel_norm IN ('marketplace', 'market_place') THEN 'marketplace' END"""
CLAMPED = f"""
  CASE WHEN unit_price <= 0 OR unit_price < {P01} THEN {P01} WHEN unit_price > {P99} THEN {P99} ELSE unit_price END"""
GOLD = f"""{POSITIVE_BOUNDS}, {KEPT},
  gold AS (SELECT order_id, date_parsed, store_id, product_id, {CLAMPED} AS unit_price, quantity, customer_id,
    {STRICT_LABEL} AS channel, channel_raw,
    unit_price IS NOT NULL AND (unit_price < {P01} OR unit_price > {P99}) AS was_winsorized,
    channel_norm NOT IN {DOMAIN} AS was_relabeled FROM kept)"""
LEGACY_GOLD = f"""{POSITIVE_BOUNDS}, {KEPT},
  gold AS (SELECT order_id, date_parsed, store_id, product_id,
    greatest(least(unit_price, {P99}), {P01}) AS unit_price, quantity, customer_id,
    CASE WHEN channel_norm IN {DOMAIN} THEN channel_norm ELSE 'online' END AS channel_norm FROM kept)"""
GOLD_COLUMNS = """order_id, date_parsed, store_id, product_id, round(unit_price, 6) AS unit_price, quantity,
  customer_id, channel, channel_raw, was_winsorized, was_relabeled"""
STG_COLUMNS = """order_id, date_parsed, store_id, product_id, round(unit_price, 6) AS unit_price, quantity,
  customer_id, channel_norm, channel_raw"""

DAILY = """
  daily AS (SELECT date_parsed AS d, COUNT(*) AS n_rows, COUNT(DISTINCT order_id) AS n_orders,
              SUM(unit_price * quantity) AS revenue FROM stg WHERE date_parsed IS NOT NULL GROUP BY date_parsed)"""
SERIES = f"""{DAILY},
  history AS (SELECT *, AVG(n_rows) OVER (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS ma7_prev,
                LAG(n_rows, 7) OVER (ORDER BY d) AS n_rows_wow FROM daily),
  series AS (SELECT d, n_rows, n_orders, revenue, ma7_prev, n_rows_wow,
               (n_rows - ma7_prev) / nullif(ma7_prev, 0) AS dev_vs_ma7, n_rows - n_orders AS dup_rows_no_dia
             FROM history)"""
FLAGS = f"""{SERIES},
  flags AS (SELECT *, coalesce(dev_vs_ma7 <= -0.20, FALSE) AS is_drop, coalesce(dev_vs_ma7 >= 0.30, FALSE) AS is_spike,
              dup_rows_no_dia > 0 AS has_excess_rows FROM series)"""
SERIES_COLUMNS = """d, n_rows, n_orders, round(revenue, 6) AS revenue, round(ma7_prev, 6) AS ma7_prev, n_rows_wow,
  round(dev_vs_ma7, 6) AS dev_vs_ma7, dup_rows_no_dia"""


def over_sales(select: str, *ctes: str, closed: bool = False, variant: str = "open") -> str:
    raw = SALES_VARIANTS["closed" if closed else variant]
    parts = [f"sales_raw AS ({raw})", f"stg AS ({STAGED})", *ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select


def metrics(table: str, label: str) -> str:
    """The eight metrics of a table, percentiles unrounded."""
    return f"""
  SELECT COUNT(*) AS n,
    COUNT(*) - COUNT(DISTINCT order_id || '|' || CAST(date_parsed AS VARCHAR)) AS dup_est,
    COUNT(*) FILTER (WHERE unit_price IS NULL OR unit_price <= 0) AS n_price_zero_or_null,
    COUNT(*) FILTER (WHERE customer_id IS NULL) AS n_missing_customer,
    COUNT(DISTINCT {label}) AS n_channel_labels,
    COUNT(*) FILTER (WHERE {label} IS NULL OR {label} NOT IN {DOMAIN}) AS n_channel_off_domain,
    quantile_cont(unit_price, 0.01) AS p01, quantile_cont(unit_price, 0.99) AS p99
  FROM {table}"""


def short_metrics(table: str, key: str = "order_id || '|' || CAST(date_parsed AS VARCHAR)", price: str = "unit_price") -> str:
    return f"""
  SELECT COUNT(*) AS n, COUNT(*) - COUNT(DISTINCT {key}) AS dup_est,
    quantile_cont({price}, 0.01) AS p01, quantile_cont({price}, 0.99) AS p99
  FROM {table} WHERE {price} IS NOT NULL"""


METRIC_COLUMNS = """n, dup_est, n_price_zero_or_null, n_missing_customer, n_channel_labels, n_channel_off_domain,
  round(p01, 6) AS p01, round(p99, 6) AS p99"""
BOTH = [GOLD, f"b AS ({metrics('stg', 'channel_norm')})", f"a AS ({metrics('gold', 'channel')})"]
B, A = "(SELECT {} FROM b)", "(SELECT {} FROM a)"


def b(column: str) -> str:
    return f"(SELECT {column} FROM b)"


def a(column: str) -> str:
    return f"(SELECT {column} FROM a)"


DROP_RATIO = f"greatest(0.0, ({b('n')} - {a('n')}) * 1.0 / {b('n')})"
GATE_COLUMNS = {
    "dedupe_zerou_duplicatas": f"{a('dup_est')} <= 0",
    "p99_nao_aumentou": f"{a('p99')} <= {b('p99')} + 1e-9",
    "canal_dentro_do_dominio": f"{a('n_channel_off_domain')} = 0",
    "customer_id_nao_inventado": f"({a('n_missing_customer')} > 0 OR {b('n_missing_customer')} = 0)",
    "perda_de_linhas_aceitavel": f"{DROP_RATIO} <= 0.20",
}
GATE_SELECT = f"SELECT CAST(round({DROP_RATIO}, 4) AS DOUBLE) AS drop_ratio, " + ", ".join(
    f"{expression} AS {name}" for name, expression in GATE_COLUMNS.items()
)
ALL_GATES = " AND ".join(f"({e})" for e in GATE_COLUMNS.values())

BASELINE = f"""
SELECT (SELECT COUNT(*) FROM stg) AS n_rows,
  (SELECT COUNT(*) FROM repeated) AS n_dup_pairs,
  (SELECT CAST(coalesce(SUM(cnt), 0) AS BIGINT) FROM repeated) AS n_dup_rows,
  (SELECT COUNT(*) FROM stg WHERE customer_id IS NULL) AS n_missing_customer,
  (SELECT COUNT(*) FROM stg WHERE unit_price IS NULL OR unit_price <= 0) AS n_price_zero_or_null,
  (SELECT COUNT(*) FROM stg WHERE quantity IS NULL OR quantity <= 0) AS n_qty_invalid,
  (SELECT COUNT(*) FROM stg WHERE date_parsed IS NULL) AS n_date_null,
  round({P01}, 6) AS p01, round({P99}, 6) AS p99"""
REPEATED = "repeated AS (SELECT order_id, date_parsed, COUNT(*) AS cnt FROM stg GROUP BY ALL HAVING COUNT(*) > 1)"
VARIANTS = f"""variants AS (SELECT channel_raw, channel_norm, COUNT(*) AS n,
  coalesce(channel_norm IN {DOMAIN}, FALSE) AS in_domain FROM stg GROUP BY channel_raw, channel_norm)"""

LONG_LABELS = (
    ("n", "Linhas", 0), ("dup_est", "Duplicatas estimadas", 0), ("n_price_zero_or_null", "`unit_price` <= 0 ou nulo", 0),
    ("n_channel_off_domain", "Canal fora do domínio", 0), ("n_missing_customer", "`customer_id` ausente", 0),
    ("n_channel_labels", "Rótulos distintos de canal", 0), ("p01", "P01 de `unit_price`", 2), ("p99", "P99 de `unit_price`", 2),
)
LONG = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, '{label}' AS label, {digits} AS digits, CAST({b(m)} AS DOUBLE) AS before_value,"
    f" CAST({a(m)} AS DOUBLE) AS after_value"
    for m, label, digits in LONG_LABELS
)


def number(value: str) -> str:
    return f"CASE WHEN digits > 0 THEN format('{{:,.2f}}', {value}) ELSE format('{{:,.0f}}', {value}) END"


def trimmed(text: str) -> str:
    return rf"regexp_replace(regexp_replace({text}, '^[\s\v]+', ''), '[\s\v]+$', '')"


def unfenced(text: str) -> str:
    """One fence off a trimmed text."""
    pattern = r"^```[a-zA-Z0-9_+-]*\s*\n((?s:.*))```$"
    return f"CASE WHEN regexp_matches({text}, '{pattern}') THEN {trimmed(f'''regexp_extract({text}, '{pattern}', 1)''')} ELSE {text} END"


def stripped(columns: str, wrapped: str, table: str) -> str:
    return f"""
WITH f0 AS (SELECT {columns}, {trimmed(wrapped)} AS t FROM {table}),
  f1 AS (SELECT {columns}, {unfenced('t')} AS t FROM f0),
  f2 AS (SELECT {columns}, {unfenced('t')} AS t FROM f1),
  f3 AS (SELECT {columns}, {unfenced('t')} AS t FROM f2)"""


def wrapped(text: str, layers: str, language: str) -> str:
    return f"repeat('```{language}' || chr(10), CAST({layers} AS INTEGER)) || {text} || repeat(chr(10) || '```', CAST({layers} AS INTEGER))"


def artifact_cte(in_prose: bool = False) -> str:
    """Path and expected problems of every artifact, from its number alone.

    Inside prose the first object is found before the list around it.
    """
    plan, findings, validation = "reports/plan.json", "reports/analysis_findings.json", "reports/validation_report.json"
    absent = "chave obrigatória ausente -> ''{}''"

    def message(path: str, *texts: str) -> str:
        return "'" + "; ".join(f"{path}: {t}" for t in texts) + "'"

    keys = [absent.format(k) for k in ("findings", "notes")]
    items = [f"findings[0] sem chave obrigatória ''{k}''" for k in ("evidence", "business_impact", "priority")]
    empty = "''findings'' deve ser lista não-vazia"
    blocked = [absent.format(k) for k in ("blocked_commands", "before_after")]
    of_list = message(findings, *keys, empty) if in_prose else message(findings, "raiz deveria ser objeto JSON, veio list")
    return f"""artifacts AS (
  SELECT doc_id, text,
    CASE doc_id % 3 WHEN 0 THEN '{plan}' WHEN 1 THEN '{findings}' ELSE '{validation}' END AS path,
    CASE doc_id % 3
      WHEN 0 THEN CASE WHEN doc_id % 5 < 3 THEN '' ELSE {message(plan, absent.format('tasks'))} END
      WHEN 1 THEN CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN {message(findings, empty)}
        WHEN 2 THEN {message(findings, *items, 'findings[1] não é objeto')}
        WHEN 3 THEN {message(findings, *keys, empty)}
        ELSE {of_list} END
      ELSE CASE WHEN doc_id % 5 = 0 THEN '' ELSE {message(validation, *blocked)} END
    END AS problems
  FROM documents)"""


WORD = r"[^\p{L}\p{N}_]"


def found(pattern: str, column: str = "sql") -> str:
    return f"regexp_matches({column}, '(?im){pattern}')"


def audit_oracle(strict: bool) -> str:
    templates = " ".join(
        f"WHEN {i} THEN '" + t.replace("'", "''") + "'" for i, t in enumerate(SQL_TEMPLATES)
    )
    rules = [
        (r"\bDROP\s+(TABLE|VIEW|SCHEMA)\s+(raw|stg)\.", "DROP em raw/stg"),
        (r"\bALTER\s+(TABLE|SCHEMA)\s+(raw|stg)\.", "ALTER em raw/stg"),
        (r"\bUPDATE\s+(raw|stg)\.", "UPDATE em raw/stg"),
        (r"\bDELETE\s+FROM\s+(raw|stg)\.", "DELETE em raw/stg"),
        (r"\b(ATTACH|DETACH|VACUUM|PRAGMA|INSTALL|LOAD|COPY\s+\(?\s*SELECT.*\)?\s*TO\s+''/)\b", "comando fora do escopo"),
        (r"\bCREATE\s+(OR\s+REPLACE\s+)?(TABLE|VIEW)\s+(raw|stg)\.", "CREATE em raw/stg"),
    ]
    if strict:
        rules += [
            (r"\bDROP\s+(TABLE|VIEW|SCHEMA)\s+IF\s+EXISTS\s+(raw|stg)\b", "DROP IF EXISTS em raw/stg"),
            (r"\bTRUNCATE\s+(TABLE\s+)?(raw|stg)\.", "TRUNCATE em raw/stg"),
            (r"\bMERGE\s+INTO\s+(raw|stg)\.", "MERGE em raw/stg"),
            (r"\bINSERT\s+(INTO|OVERWRITE)\s+(TABLE\s+)?(raw|stg)\.", "INSERT em raw/stg"),
        ]
    required = [
        (r"\bCREATE\s+OR\s+REPLACE\s+TABLE\s+gold\.sales_clean\b", "CREATE OR REPLACE TABLE gold.sales_clean"),
        (r"\bROW_NUMBER\s*\(\s*\)\s*OVER", "deduplicação via ROW_NUMBER()"),
    ]
    blocked = ", ".join(f"CASE WHEN {found(p)} THEN '{m}' END" for p, m in rules)
    missing = ", ".join(f"CASE WHEN NOT {found(p)} THEN '{m}' END" for p, m in required)
    bare = found(r"(^|[^\p{L}\p{N}_.])channel($|[^\p{L}\p{N}_])", r"regexp_replace(sql, '\bAS\s+channel\b', '', 'gi')")
    unknown = ", ".join(
        [f"CASE WHEN {found(rf'\b{c}\b')} THEN '{c}' END" for c in ("created_at", "updated_at", "ingested_at")]
        + [f"CASE WHEN {bare} THEN 'channel (na staging use channel_norm ou channel_raw)' END"]
    )
    columns = "doc_id, blocked, safe" if strict else "doc_id, blocked, missing, unknown, safe"
    return f"""
WITH texts AS (SELECT doc_id, CASE doc_id % {len(SQL_TEMPLATES)} {templates} END || chr(10) || '-- ' || text AS sql FROM documents),
judged AS (SELECT doc_id, concat_ws('; ', {blocked}) AS blocked, concat_ws('; ', {missing}) AS missing,
  concat_ws('; ', {unknown}) AS unknown FROM texts)
SELECT {columns.replace('safe', "blocked = '' AND unknown = '' AS safe")} FROM judged"""


def _staging() -> dict[str, str]:
    raw = "order_id, date, store_id, product_id, unit_price, quantity, customer_id, channel"
    return {
        "stage_sales_rows": over_sales(f"SELECT {STG_COLUMNS} FROM stg"),
        "parse_dates_multiformat": over_sales("""
SELECT order_id, date, coalesce(CAST(try_strptime(trim(date), '%Y-%m-%d') AS DATE),
  CAST(try_strptime(trim(date), '%d/%m/%Y') AS DATE), CAST(try_strptime(trim(date), '%Y/%m/%d') AS DATE)) AS date_parsed
FROM sales_raw"""),
        "safe_cast_numeric": over_sales("""
SELECT order_id, round(TRY_CAST(unit_price AS DOUBLE), 6) AS unit_price, TRY_CAST(quantity AS INTEGER) AS quantity,
  TRY_CAST(unit_price AS INTEGER) AS price_as_int FROM sales_raw"""),
        "blank_to_null_customers": over_sales("SELECT order_id, nullif(trim(customer_id), '') AS customer_id FROM sales_raw"),
        "normalize_labels": over_sales(
            "SELECT order_id, channel, lower(replace(replace(channel, '-', '_'), ' ', '_')) AS channel_norm FROM sales_raw"
        ),
        "normalize_labels_orders": """
SELECT o_orderkey, lower(replace(replace(o_orderpriority, '-', '_'), ' ', '_')) AS priority_norm FROM orders""",
        "composite_keys": over_sales("""
SELECT product_id, order_id || '|' || CAST(date_parsed AS VARCHAR) AS row_key, order_id || '|' || customer_id AS customer_key
FROM stg"""),
        "ingest_csv": over_sales(f"SELECT {STG_COLUMNS} FROM stg"),
        "raw_roundtrip": over_sales(f"SELECT {raw} FROM sales_raw"),
        "csv_scan_lenient": over_sales(f"SELECT {raw} FROM sales_raw"),
        "csv_scan_by_name": over_sales(f"SELECT {raw} FROM sales_raw"),
        "csv_rejects": over_sales("""
SELECT concat_ws(',', coalesce(order_id, ''), coalesce(date, ''), coalesce(store_id, ''), coalesce(product_id, ''),
  coalesce(unit_price, ''), coalesce(quantity, ''), coalesce(customer_id, '')) || tail AS line
FROM (SELECT *, unnest(['', ',' || coalesce(channel, '') || ',x']) AS tail FROM sales_raw WHERE quantity = '-1')"""),
    }


def _profile() -> dict[str, str]:
    baseline = over_sales(BASELINE, NONNULL_BOUNDS, REPEATED)
    group_percentiles = """
SELECT l_suppkey, round(quantile_cont(l_extendedprice, {}), 6) AS p01, round(quantile_cont(l_extendedprice, {}), 6) AS p99
FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_suppkey"""
    percentiles = over_sales(f"SELECT round({P01}, 6) AS p01, round({P99}, 6) AS p99", NONNULL_BOUNDS)
    return {
        "baseline_checks": baseline,
        "metrics_json": baseline,
        "invalid_counts": over_sales("""
SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE customer_id IS NULL) AS n_missing_customer,
  COUNT(*) FILTER (WHERE unit_price IS NULL OR unit_price <= 0) AS n_price_zero_or_null,
  COUNT(*) FILTER (WHERE quantity IS NULL OR quantity <= 0) AS n_qty_invalid,
  COUNT(*) FILTER (WHERE date_parsed IS NULL) AS n_date_null FROM stg"""),
        "price_percentiles": percentiles,
        "price_percentiles_distributed": percentiles,
        "percentiles_by_group": group_percentiles.format(0.01, 0.99),
        "percentiles_by_group_distributed": group_percentiles.format(0.05, 0.95),
        "duplicate_groups": over_sales("SELECT * FROM repeated", REPEATED),
        "duplicate_summary": over_sales(
            "SELECT COUNT(*) AS n_dup_pairs, CAST(coalesce(SUM(cnt), 0) AS BIGINT) AS n_dup_rows FROM repeated", REPEATED
        ),
        "duplicate_summary_lineitem": """
SELECT COUNT(*) - COUNT(DISTINCT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_shipdate AS VARCHAR)) AS dup_est,
  COUNT(*) FILTER (WHERE l_orderkey IS NULL OR l_shipdate IS NULL) AS n_null_key FROM lineitem""",
        "metrics_table": over_sales(f"SELECT {METRIC_COLUMNS} FROM m", f"m AS ({metrics('stg', 'channel_norm')})"),
        "metrics_table_without_label": over_sales(
            f"SELECT {METRIC_COLUMNS} FROM m", f"m AS ({metrics('stg', 'CAST(NULL AS VARCHAR)')})"
        ),
        "metrics_nonnull_price": over_sales(
            "SELECT n, dup_est, round(p01, 6) AS p01, round(p99, 6) AS p99 FROM m", f"m AS ({short_metrics('stg')})"
        ),
        "metrics_stacked": over_sales(
            f"SELECT 'stg' AS stage, {METRIC_COLUMNS} FROM b UNION ALL SELECT 'gold' AS stage, {METRIC_COLUMNS} FROM a", *BOTH
        ),
    }


def _evidence() -> dict[str, str]:
    series = over_sales(f"SELECT {SERIES_COLUMNS} FROM series", SERIES)
    days = ", ".join(f"DATE '{d}'" for d in SELECTED_DAYS)
    holidays = ", ".join(f"(DATE '{d}', '{name}')" for d, name in HOLIDAYS)
    by_store = SERIES.replace("SELECT date_parsed AS d", "SELECT store_id, date_parsed AS d").replace(
        "GROUP BY date_parsed", "GROUP BY store_id, date_parsed").replace(
        "OVER (ORDER BY d", "OVER (PARTITION BY store_id ORDER BY d").replace("SELECT d, n_rows", "SELECT store_id, d, n_rows")
    history = by_store[by_store.index("history AS"):].replace("FROM daily", "FROM filled")
    filled = f"""
  daily AS (SELECT store_id, date_parsed AS d, COUNT(*) AS n_rows, COUNT(DISTINCT order_id) AS n_orders,
              SUM(unit_price * quantity) AS revenue FROM stg
            WHERE date_parsed IS NOT NULL GROUP BY store_id, date_parsed),
  calendar AS (SELECT store_id, CAST(unnest(generate_series(MIN(d), MAX(d), INTERVAL 1 DAY)) AS DATE) AS d
               FROM daily GROUP BY store_id),
  filled AS (SELECT c.store_id, c.d, coalesce(n_rows, 0) AS n_rows, coalesce(n_orders, 0) AS n_orders,
               coalesce(revenue, 0) AS revenue
             FROM calendar c LEFT JOIN daily d ON c.store_id = d.store_id AND c.d = d.d), {history}"""
    verdict = """CASE WHEN has_excess_rows THEN 'bug' {} WHEN is_drop THEN 'business' WHEN is_spike THEN 'unexplained_spike'
  ELSE 'normal' END AS verdict"""
    explained = "WHEN is_drop AND holiday IS NOT NULL THEN 'explained'"
    judged = f"SELECT d, n_rows, dup_rows_no_dia, {verdict.format('')} FROM flags"
    marks = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, d FROM flags WHERE {mark}"
        for kind, mark in (("drop", "is_drop"), ("spike", "is_spike"), ("excess_rows", "has_excess_rows"))
    )
    shown = f"d BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
    return {
        "daily_rollup": over_sales("SELECT d, n_rows, n_orders, round(revenue, 6) AS revenue FROM daily", DAILY),
        "moving_average_prev7": over_sales("SELECT d, n_rows, round(ma7_prev, 6) AS ma7_prev FROM series", SERIES),
        "lag_wow": over_sales("SELECT d, n_rows, n_rows_wow FROM series", SERIES),
        "seasonality_daily": over_sales(
            f"SELECT {SERIES_COLUMNS} FROM series WHERE {shown} ORDER BY d", SERIES
        ),
        "seasonality_by_store": over_sales(f"SELECT store_id, {SERIES_COLUMNS} FROM series", by_store),
        "seasonality_full_calendar": over_sales(f"SELECT store_id, {SERIES_COLUMNS} FROM series", filled, variant="sundays"),
        "seasonality_flags": over_sales(f"SELECT {SERIES_COLUMNS}, is_drop, is_spike, has_excess_rows FROM flags", FLAGS),
        "seasonality_selected_days": over_sales(
            f"SELECT d, n_rows, n_orders, dup_rows_no_dia, format('{{:+.1f}}%', dev_vs_ma7 * 100) AS deviation "
            f"FROM flags WHERE d IN ({days})", FLAGS
        ),
        "flagged_days": over_sales(marks, FLAGS),
        "evidence_flagged_days": over_sales(f"SELECT * FROM ({marks}) AS m WHERE {shown}", FLAGS),
        "classify_days": over_sales(judged, FLAGS),
        "evidence_verdicts": over_sales(f"{judged} WHERE {shown}", FLAGS),
        "classify_days_calendar": over_sales(
            f"SELECT f.d, n_rows, holiday, {verdict.format(explained)} "
            f"FROM flags f LEFT JOIN (VALUES {holidays}) AS h(d, holiday) ON f.d = h.d", FLAGS
        ),
        "series_records_json": series,
        "chart_series": over_sales(
            "SELECT strftime(d, '%m-%d') AS day, n_rows, round(ma7_prev, 6) AS ma7_prev FROM series", SERIES
        ),
        "chart_labels": over_sales("SELECT channel_raw, n, in_domain FROM variants", VARIANTS),
        "label_variants": over_sales("SELECT channel_raw, channel_norm, n FROM variants ORDER BY n DESC, channel_raw", VARIANTS),
        "evidence_labels": over_sales("SELECT * FROM variants", VARIANTS),
        "label_off_domain": over_sales("SELECT * FROM variants WHERE NOT in_domain", VARIANTS),
        "label_off_domain_total": over_sales(
            "SELECT CAST(coalesce(SUM(n), 0) AS BIGINT) AS n_rows, COUNT(*) AS n_labels FROM variants WHERE NOT in_domain", VARIANTS
        ),
        "label_topk": over_sales(
            "SELECT channel_raw, channel_norm, n FROM variants ORDER BY n DESC, channel_raw, channel_norm LIMIT 5", VARIANTS
        ),
    }


def _clean() -> dict[str, str]:
    greatest = "greatest(least(unit_price, {}), {})"
    prices = "SELECT order_id, product_id, round(unit_price, 6) AS unit_price, round({}, 6) AS unit_price_wins FROM {}"
    per_product = """bounds AS (SELECT product_id, quantile_cont(unit_price, 0.01) AS p01, quantile_cont(unit_price, 0.99) AS p99
  FROM stg WHERE unit_price IS NOT NULL GROUP BY product_id)"""
    wide_bounds = NONNULL_BOUNDS.replace("0.01", "0.05").replace("0.99", "0.95")
    clipped = "CASE WHEN unit_price < {0} THEN {0} WHEN unit_price > {1} THEN {1} ELSE unit_price END"
    agent_label = STRICT_LABEL.replace(", 'instore'", "")
    keys = over_sales("SELECT DISTINCT order_id, date_parsed FROM stg")
    strict = over_sales(f"SELECT order_id, channel_norm, {STRICT_LABEL} AS channel FROM stg")
    return {
        "winsor_bounds": over_sales(f"SELECT round({P01}, 6) AS p01, round({P99}, 6) AS p99", POSITIVE_BOUNDS),
        "winsorize_global": over_sales(prices.format(CLAMPED, "stg"), POSITIVE_BOUNDS),
        "winsorize_greatest_least": over_sales(prices.format(greatest.format(P99, P01), "stg"), NONNULL_BOUNDS),
        "winsorize_fixed": over_sales(prices.format(clipped.format("33.8652", "229.2788"), "stg")),
        "winsorize_clip": over_sales(prices.format(clipped.format(P01, P99), "stg"), wide_bounds),
        "winsorize_by_group": """
WITH bounds AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.01) AS p01, quantile_cont(l_extendedprice, 0.99) AS p99
  FROM lineitem WHERE l_extendedprice IS NOT NULL GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, l_suppkey, round(l_extendedprice, 6) AS l_extendedprice,
  round(CASE WHEN l_extendedprice < p01 THEN p01 WHEN l_extendedprice > p99 THEN p99 ELSE l_extendedprice END, 6) AS price_wins
FROM lineitem LEFT JOIN bounds USING (l_suppkey)""",
        "winsorize_by_product": over_sales(
            prices.format(greatest.format("p99", "p01"), "stg LEFT JOIN bounds USING (product_id)"), per_product
        ),
        "map_labels_strict": strict,
        "map_labels_joined": strict,
        "map_labels_default": over_sales(f"""
SELECT order_id, channel_raw, CASE WHEN channel_norm IN {DOMAIN} THEN channel_norm
  WHEN lower(replace(replace(channel_raw, '-', '_'), ' ', '_')) IN {DOMAIN}
  THEN lower(replace(replace(channel_raw, '-', '_'), ' ', '_')) ELSE 'online' END AS channel_norm FROM stg"""),
        "dedupe_deterministic": over_sales(f"SELECT {STG_COLUMNS} FROM kept", KEPT),
        "dedupe_lineitem": """
SELECT l_orderkey, l_shipdate, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST,
    l_linenumber NULLS LAST, l_extendedprice NULLS LAST, l_quantity NULLS LAST) AS place FROM lineitem) AS numbered
WHERE place = 1""",
        "dedupe_hash": keys,
        "dedupe_any": keys,
        "audit_flags": over_sales("SELECT order_id, date_parsed, was_winsorized, was_relabeled FROM gold", GOLD),
        "audit_flag_totals": over_sales("""
SELECT COUNT(*) FILTER (WHERE was_winsorized) AS n_winsorized, COUNT(*) FILTER (WHERE was_relabeled) AS n_relabeled
FROM gold""", GOLD),
        "clean_reference": over_sales(f"SELECT {GOLD_COLUMNS} FROM gold", GOLD),
        "clean_reference_distributed": over_sales(f"SELECT {GOLD_COLUMNS} FROM gold", GOLD, closed=True),
        "clean_agent_variant": over_sales(f"""
SELECT * FROM (SELECT order_id, date_parsed, store_id, product_id,
  round({clipped.format('33.8652', '229.2788')}, 6) AS unit_price, quantity, customer_id, {agent_label} AS channel_norm,
  channel_raw FROM kept) AS clamped WHERE unit_price > 0""", KEPT, variant="keyed"),
        "clean_legacy": over_sales("""
SELECT order_id, date_parsed, store_id, product_id, round(unit_price, 6) AS unit_price, quantity, customer_id, channel_norm
FROM gold""", LEGACY_GOLD, variant="keyed"),
    }


def _publish() -> dict[str, str]:
    short = [f"b AS ({short_metrics('stg')})", f"a AS ({short_metrics('gold')})"]
    deltas = ", ".join(
        f"round({b(m)}, 6) AS {name}_before, round({a(m)}, 6) AS {name}_after, round({a(m)} - {b(m)}, 6) AS {name}_delta"
        if m in ("p01", "p99") else f"{b(m)} AS {name}_before, {a(m)} AS {name}_after, {a(m)} - {b(m)} AS {name}_delta"
        for m, name in (("n", "n"), ("dup_est", "dup"), ("p01", "p01"), ("p99", "p99"))
    )
    legacy_gates = {
        "dup_est_to_zero": f"{a('dup_est')} <= 0", "p99_non_increasing": f"{a('p99')} <= {b('p99')}",
        "drop_ratio_ok": f"{DROP_RATIO} <= 0.20",
    }
    decided = f"""{{}} AS drop_ratio, {ALL_GATES} AS ok,
  CASE WHEN {ALL_GATES} THEN 'APROVADO para aplicar' ELSE 'NECESSITA REVISÃO' END AS decision"""
    decided = "SELECT " + decided.format(f"CAST(round({DROP_RATIO}, 4) AS DOUBLE)")
    report = " UNION ALL ".join(
        f"SELECT '{name}' AS gate, {e} AS passed, format('{{:.2f}}%', round({DROP_RATIO}, 4) * 100) AS loss"
        for name, e in GATE_COLUMNS.items()
    )
    row_loss = """
SELECT '{0}' AS second_key, CAST(round((COUNT(*) - COUNT(DISTINCT (l_orderkey, {0}))) * 1.0 / COUNT(*), 4) AS DOUBLE) AS drop_ratio,
  TRUE AS dup_est_to_zero, (COUNT(*) - COUNT(DISTINCT (l_orderkey, {0}))) * 1.0 / COUNT(*) <= 0.20 AS drop_ratio_ok
FROM lineitem WHERE l_extendedprice IS NOT NULL"""
    gold_closed = over_sales(f"SELECT {GOLD_COLUMNS} FROM gold", GOLD, closed=True)
    gold = over_sales(f"SELECT {GOLD_COLUMNS} FROM gold", GOLD)
    swap = "order_id, date_parsed, quantity, channel_norm"
    agent = f"""agent AS (SELECT order_id, date_parsed, quantity, {STRICT_LABEL.replace(", 'instore'", "")} AS channel_norm
  FROM kept WHERE CASE WHEN unit_price < 33.8652 THEN 33.8652 WHEN unit_price > 229.2788 THEN 229.2788 ELSE unit_price END > 0)"""
    return {
        "before_after_wide": over_sales(
            f"SELECT {deltas}, round(({a('n')} - {b('n')}) * 1.0 / nullif({b('n')}, 0), 6) AS n_pct_delta", GOLD, *short
        ),
        "before_after_long": over_sales(
            'SELECT metric, label, digits, round(before_value, 6) AS "before", round(after_value, 6) AS "after", '
            "round(after_value - before_value, 6) AS delta FROM long", *BOTH, f"long AS ({LONG})"
        ),
        "before_after_formatted": over_sales(
            f"SELECT label, {number('before_value')} AS \"before\", {number('after_value')} AS \"after\", "
            f"CASE WHEN after_value < before_value THEN '-' ELSE '+' END || {number('abs(after_value - before_value)')} AS delta "
            "FROM long", *BOTH, f"long AS ({LONG})"
        ),
        "acceptance_gates": over_sales(f"{GATE_SELECT}, {ALL_GATES} AS ok", *BOTH),
        "acceptance_gates_closed": over_sales(f"{GATE_SELECT}, {ALL_GATES} AS ok", *BOTH, closed=True),
        "gates_legacy": over_sales(
            f"SELECT CAST(round({DROP_RATIO}, 4) AS DOUBLE) AS drop_ratio, "
            + ", ".join(f"{e} AS {n}" for n, e in legacy_gates.items())
            + ", " + " AND ".join(f"({e})" for e in legacy_gates.values()) + " AS ok",
            LEGACY_GOLD, *short, variant="keyed",
        ),
        "gates_lineitem_row_loss": row_loss.format("l_shipdate") + " UNION ALL " + row_loss.format("l_linenumber"),
        "gate_report": over_sales(report, *BOTH),
        "decision": f"SELECT * FROM ({over_sales(decided, *BOTH)}) UNION ALL SELECT * FROM ({over_sales(decided, *BOTH, closed=True)})",
        "dry_run_before_after": over_sales(
            f"SELECT 'stg' AS stage, {METRIC_COLUMNS} FROM b UNION ALL SELECT 'gold_simulated' AS stage, {METRIC_COLUMNS} FROM a",
            POSITIVE_BOUNDS, KEPT,
            f"""gold AS (SELECT order_id, date_parsed, customer_id, {STRICT_LABEL} AS channel,
  CASE WHEN unit_price < {P01} THEN {P01} WHEN unit_price > {P99} THEN {P99} ELSE unit_price END AS unit_price FROM kept)""",
            *BOTH[1:],
        ),
        "fallback_choice": over_sales(f"""
SELECT 'never written' AS candidate, FALSE AS chosen, 'missing' AS reason, CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS dup_est
UNION ALL SELECT 'unknown column', FALSE, 'AnalysisException', NULL, NULL
UNION ALL SELECT 'not a query', FALSE, 'ParseException', NULL, NULL
UNION ALL SELECT 'reference', TRUE, NULL, {a('n')}, {a('dup_est')}""", *BOTH),
        "readonly_query": over_sales("""
SELECT channel_norm, store_id, COUNT(*) AS n FROM stg GROUP BY ALL ORDER BY n DESC, channel_norm, store_id LIMIT 50"""),
        "sample_rows": over_sales(f"SELECT {STG_COLUMNS} FROM stg ORDER BY order_id, date_parsed, store_id, product_id, stg.unit_price LIMIT 5"),
        "apply_gold_readback": gold_closed,
        "gold_ctas_idempotent": gold,
        "snapshot_csv_roundtrip": gold,
        "swap_promote": over_sales(
            f"SELECT 'current' AS role, {swap} FROM gold UNION ALL SELECT 'backup' AS role, {swap} FROM agent", LEGACY_GOLD, agent, variant="keyed",
        ),
    }


def _text() -> dict[str, str]:
    documents = "' ' || chr(10) || " + wrapped("text", "doc_id % 5", "sql") + " || ' ' || chr(10)"
    violated = artifact_cte()
    return {
        "strip_fences_documents": stripped("doc_id", documents, "documents").replace("doc_id, t", "doc_id, t")
        + "\nSELECT doc_id, length(t) AS n_chars, md5(t) AS text_md5 FROM f3",
        "strip_fences_conversations": stripped("conv_id, turn", wrapped("text", "turn % 3", "json"), "conversations")
        + "\nSELECT conv_id, turn, md5(t) AS text_md5 FROM f3",
        "extract_json_documents": """
SELECT doc_id AS id, CASE WHEN doc_id % 4 < 3 THEN doc_id END AS doc_id, CASE WHEN doc_id % 4 < 3 THEN lang END AS lang,
  CASE WHEN doc_id % 4 < 3 THEN source END AS source, CASE WHEN doc_id % 4 < 3 THEN md5(text) END AS text_md5
FROM documents""",
        "artifact_violations_documents": f"WITH {violated} SELECT doc_id, path, problems FROM artifacts",
        "sanitize_artifacts": f"""
WITH {artifact_cte(in_prose=True)}, located AS (
  SELECT doc_id, text, problems, CASE WHEN doc_id % 7 IN (3, 4) THEN 'reports/patch.sql' ELSE path END AS path FROM artifacts),
judged AS (SELECT doc_id, path, text, CASE doc_id % 7 WHEN 1 THEN path || ': arquivo não gerado'
  WHEN 2 THEN path || ': Nenhum JSON válido encontrado na saída do agente.' WHEN 3 THEN path || ': conteúdo vazio'
  WHEN 4 THEN '' ELSE problems END AS problems FROM located)
SELECT doc_id, path, problems = '' AS ok, problems, CASE WHEN doc_id % 7 = 4 THEN md5({trimmed('text')}) END AS text_md5
FROM judged""",
        "audit_sql_texts": audit_oracle(strict=False),
        "audit_sql_texts_strict": audit_oracle(strict=True),
    }


def _extensions() -> dict[str, str]:
    rules = {
        "date_missing": "date_parsed IS NULL",
        "label_off_domain": f"channel_norm IS NULL OR channel_norm NOT IN {DOMAIN}",
        "price_not_positive": "unit_price IS NULL OR unit_price <= 0",
        "quantity_not_positive": "quantity IS NULL OR quantity <= 0",
    }
    counted = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, COUNT(*) AS violations, COUNT(*) = 0 AS holds FROM stg WHERE {bad}" for name, bad in rules.items()
    )
    good = " AND ".join(f"NOT ({bad})" for bad in rules.values())
    later = KEPT.replace("FROM stg", f"FROM stg WHERE date_parsed > DATE '{SPLIT_DAY}' AND order_id IS NOT NULL")
    unkeyed = f"SELECT DISTINCT {STG_COLUMNS} FROM stg WHERE date_parsed > DATE '{SPLIT_DAY}' AND order_id IS NULL"
    return {
        "contract_violations": over_sales(
            counted + " UNION ALL SELECT 'duplicate_keys', COUNT(*), COUNT(*) = 0 FROM repeated", REPEATED
        ),
        "idempotent_append": over_sales(
            f"SELECT {STG_COLUMNS} FROM stg WHERE date_parsed IS NULL OR date_parsed <= DATE '{SPLIT_DAY}' "
            f"UNION ALL SELECT {STG_COLUMNS} FROM kept UNION ALL {unkeyed}", later,
        ),
        "percentile_drift": over_sales("""
SELECT period, n, round(p01, 6) AS p01, round(p99, 6) AS p99,
  round(p01 - LAG(p01) OVER (ORDER BY period), 6) AS p01_change, round(p99 - LAG(p99) OVER (ORDER BY period), 6) AS p99_change
FROM periods""", """periods AS (SELECT CAST(date_trunc('week', date_parsed) AS DATE) AS period, COUNT(unit_price) AS n,
  quantile_cont(unit_price, 0.01) AS p01, quantile_cont(unit_price, 0.99) AS p99
  FROM stg WHERE date_parsed IS NOT NULL AND unit_price IS NOT NULL GROUP BY 1)"""),
        "trim_outliers": over_sales(
            f"SELECT order_id, product_id, round(unit_price, 6) AS unit_price FROM stg WHERE unit_price BETWEEN {P01} AND {P99}",
            POSITIVE_BOUNDS,
        ),
        "outliers_vs_median": over_sales("""
SELECT order_id, product_id, round(unit_price, 6) AS unit_price, round(middle, 6) AS median
FROM stg JOIN middles USING (product_id) WHERE unit_price > 10 * middle""",
            "middles AS (SELECT product_id, quantile_cont(unit_price, 0.5) AS middle FROM stg WHERE unit_price > 0 GROUP BY product_id)"),
        "outliers_vs_median_lineitem": """
WITH middles AS (SELECT l_suppkey, quantile_cont(l_extendedprice, 0.5) AS middle FROM lineitem WHERE l_extendedprice > 0 GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, l_suppkey, round(l_extendedprice, 6) AS l_extendedprice, round(middle, 6) AS median
FROM lineitem JOIN middles USING (l_suppkey) WHERE l_extendedprice > 1.9 * middle""",
        "stream_dedupe": over_sales("SELECT DISTINCT order_id, date_parsed FROM stg"),
        "stream_contract": over_sales(
            f"SELECT {STG_COLUMNS} FROM kept UNION ALL SELECT DISTINCT {STG_COLUMNS} FROM stg WHERE {good} AND order_id IS NULL",
            KEPT.replace("FROM stg", f"FROM stg WHERE {good} AND order_id IS NOT NULL"),
        ),
    }


def _stores() -> dict[str, str]:
    ranged = f"date_parsed BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
    probabilities = ", ".join(f"(CAST({p} AS DOUBLE))" for p in SKETCHED.values())
    rules = {
        "date_missing": "date_parsed IS NULL",
        "label_off_domain": f"channel_norm IS NULL OR channel_norm NOT IN {DOMAIN}",
        "price_not_positive": "unit_price IS NULL OR unit_price <= 0",
        "quantity_not_positive": "quantity IS NULL OR quantity <= 0",
    }
    good = " AND ".join(f"NOT ({bad})" for bad in rules.values())
    counters = {name: f"COUNT(*) FILTER (WHERE {bad})" for name, bad in rules.items()}
    counters["repeated_rows"] = "COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_id, date_parsed FROM stg))"
    accepted = f"(SELECT COUNT(*) FROM (SELECT DISTINCT order_id, date_parsed FROM stg WHERE {good} AND order_id IS NOT NULL))"
    observed = " UNION ALL ".join(
        f"SELECT 'all rows' AS load, COUNT(*) AS n_rows, '{rule}' AS rule, {n} AS violations, FALSE AS published, {accepted} AS rows_read FROM stg "
        f"UNION ALL SELECT 'good rows', {accepted}, '{rule}', 0, TRUE, {accepted}"
        for rule, n in counters.items()
    )
    touched = f"date_parsed IN ({', '.join(f"DATE '{d}'" for d in CORRECTED_DAYS)})"
    number = "TRY_CAST(order_id AS BIGINT)"
    merged = STG_COLUMNS.replace("round(unit_price, 6)", f"round(CASE WHEN {touched} AND {number} % 7 = 0 THEN unit_price + 1 ELSE unit_price END, 6)")

    short = "order_id, date_parsed, quantity, channel_norm"
    clipped = "CASE WHEN unit_price < 33.8652 THEN 33.8652 WHEN unit_price > 229.2788 THEN 229.2788 ELSE unit_price END"
    agent = f"""agent AS (SELECT order_id, date_parsed, store_id, product_id, {clipped} AS unit_price, quantity, customer_id,
      {STRICT_LABEL.replace(", 'instore'", "")} AS channel_norm, channel_raw FROM kept WHERE {clipped} > 0)"""
    stages = {"stg": b, "gold_simulated": a, "gold_real": a}
    names = ("n", "dup_est", "n_price_zero_or_null", "n_missing_customer", "n_channel_labels", "n_channel_off_domain", "p01", "p99")
    report = " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{name}' AS metric, round(CAST({side(name)} AS DOUBLE), 6) AS value, 'reference' AS patch, "
        f"TRUE AS applied, '{DECISION_APPROVED}' AS decision"
        for stage, side in stages.items() for name in names
    )
    return {
        "percentile_sketch_range": over_sales(
            f"SELECT store_id, probability, COUNT(unit_price) AS n, TRUE AS within FROM stg, (VALUES {probabilities}) AS p(probability) "
            f"WHERE {ranged} GROUP BY store_id, probability"
        ),
        "distinct_sketch_range": over_sales(
            f"SELECT store_id, COUNT(DISTINCT date_parsed) AS n_days, COUNT(DISTINCT order_id) AS n_orders, TRUE AS within "
            f"FROM stg WHERE {ranged} GROUP BY store_id"
        ),
        "contract_observed": over_sales(observed),
        "merge_sales": over_sales(
            f"SELECT {merged} FROM kept WHERE NOT coalesce({touched} AND {number} % 11 = 0 AND {number} % 7 <> 0, FALSE)", KEPT
        ),
        "publish_versions": over_sales(
            f"SELECT 'first' AS role, {short} FROM agent UNION ALL SELECT 'current', {short} FROM agent "
            f"UNION ALL SELECT 'second', {short} FROM gold", LEGACY_GOLD, agent, variant="keyed",
        ),
        "workflow_report": over_sales(report, *BOTH, closed=True),
        "workflow_gates": over_sales(
            " UNION ALL ".join(f"SELECT '{name}' AS gate, {expression} AS passed" for name, expression in GATE_COLUMNS.items()), *BOTH, closed=True,
        ),
        "fallback_notice": over_sales(f"""
SELECT 'never written' AS candidate, FALSE AS chosen, 'missing' AS reason, 'reference' AS effective, {a('n')} AS n_rows
UNION ALL SELECT 'unknown column', FALSE, 'AnalysisException', 'reference', {a('n')}
UNION ALL SELECT 'reference', TRUE, NULL, 'reference', {a('n')}""", *BOTH, closed=True),
        "patch_row_diff": over_sales(
            "SELECT order_id, date_parsed, kind, changed, COUNT(*) AS n FROM pairs GROUP BY ALL", GOLD, *row_pairs("gold")
        ),
        "patch_diff_summary": over_sales(
            "SELECT kind, changed, COUNT(*) AS n FROM pairs GROUP BY ALL", KEPT, agent, *row_pairs("agent"), variant="keyed"
        ),
        "user_function_by_group": """
WITH steps AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d,
    date_diff('day', CAST(LAG(l_shipdate) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate) AS DATE), CAST(l_shipdate AS DATE)) AS step FROM lineitem)
SELECT l_suppkey, MIN(d) AS "first", MAX(d) AS "last", coalesce(MAX(step), 0) AS gap, COUNT(*) AS n_rows FROM steps GROUP BY l_suppkey""",
        "text_artifact_scan": """
SELECT doc_id, large, CASE WHEN large THEN 'too large' ELSE 'read' END AS state, CASE WHEN NOT large THEN md5(text) END AS text_md5,
  TRUE AS strict_as_expected
FROM (SELECT doc_id, text, 23 + octet_length(encode(CAST(to_json([text]) AS VARCHAR))) > 40000 AS large FROM documents) AS sized""",
    }


def row_pairs(after: str) -> list[str]:
    """Copies that one side has more of, and how those of a key pair up in the order of their content."""
    content = ("store_id", "product_id", "unit_price", "quantity", "customer_id", "channel_raw")
    columns = ", ".join(("order_id", "date_parsed", *content))
    copies = f"SELECT {columns}, row_number() OVER (PARTITION BY {columns}) AS copy FROM {{}}"
    order = ", ".join(f"{c} NULLS FIRST" for c in content)
    placed = f"SELECT *, row_number() OVER (PARTITION BY order_id, date_parsed ORDER BY {order}) AS place FROM ({{}} EXCEPT {{}})"
    changed = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM w.{c} THEN '{c}' END" for c in content)
    return [
        f"old_rows AS ({placed.format(copies.format('stg'), copies.format(after))})",
        f"new_rows AS ({placed.format(copies.format(after), copies.format('stg'))})",
        f"""pairs AS (SELECT coalesce(o.order_id, w.order_id) AS order_id, coalesce(o.date_parsed, w.date_parsed) AS date_parsed,
  CASE WHEN o.place IS NULL THEN 'added' WHEN w.place IS NULL THEN 'removed' ELSE 'changed' END AS kind,
  CASE WHEN o.place IS NULL OR w.place IS NULL THEN '' ELSE concat_ws(',', {changed}) END AS changed
  FROM old_rows o FULL JOIN new_rows w ON o.order_id = w.order_id AND o.date_parsed = w.date_parsed AND o.place = w.place)""",
    ]


#: Evidence tables and the queries that show the same rows.
SAME_ROWS = {
    "evidence_seasonality": "seasonality_selected_days", "evidence_off_domain_labels": "label_off_domain",
    "evidence_off_domain": "label_off_domain_total", "evidence_before_after": "before_after_long", "evidence_gates": "gate_report",
}


def oracle_sql() -> dict[str, str]:
    named = {**_staging(), **_profile(), **_evidence(), **_clean(), **_publish(), **_text(), **_extensions(), **_stores()}
    return named | {name: named[other] for name, other in SAME_ROWS.items()}
