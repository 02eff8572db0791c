"""Values that the results depend on, stated as they are and kept together.

Nothing in this module is logic.  Column names, label domains, patterns and
message texts must equal the published ones for results to agree; everything
that decides *how* they are used lives elsewhere.
"""

# --- fixed values: tables and keys -----------------------------------------
RAW_TABLE = "raw.sales"
STAGING_TABLE = "stg.sales"
GOLD_TABLE = "gold.sales_clean"
KEYS = ("order_id", "date_parsed")

# --- fixed values: staging --------------------------------------------------
# One letter for month and day: padded and unpadded dates are both accepted.
DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "yyyy/M/d")

# --- fixed values: channel labels -------------------------------------------
CHANNEL_DOMAIN = ("online", "in_store", "marketplace")
CHANNEL_MAP = {
    "online": ("online", "on_line"),
    "in_store": ("in_store", "store", "instore"),
    "marketplace": ("marketplace", "market_place"),
}
CHANNEL_MAP_WITHOUT_INSTORE = {
    "online": ("online", "on_line"),
    "in_store": ("in_store", "store"),
    "marketplace": ("marketplace", "market_place"),
}
CHANNEL_DEFAULT = "online"
CHANNEL_COLUMN_CANDIDATES = ("channel_norm", "channel", "channel_raw")

# --- fixed values: winsorisation --------------------------------------------
P_LOW = 0.01
P_HIGH = 0.99
DOCUMENTED_P01 = 33.8652
DOCUMENTED_P99 = 229.2788
OUTLIER_MEDIAN_FACTOR = 10.0

# --- fixed values: seasonality thresholds -----------------------------------
DROP_THRESHOLD = -0.20
SPIKE_THRESHOLD = 0.30
MOVING_AVERAGE_DAYS = 7

# --- fixed values: acceptance gates -----------------------------------------
MAX_DROP_RATIO = 0.20
P99_TOLERANCE = 1e-9
GATE_DEDUPE = "dedupe_zerou_duplicatas"
GATE_P99 = "p99_nao_aumentou"
GATE_CHANNEL = "canal_dentro_do_dominio"
GATE_CUSTOMER = "customer_id_nao_inventado"
GATE_ROW_LOSS = "perda_de_linhas_aceitavel"
LEGACY_GATE_DEDUPE = "dup_est_to_zero"
LEGACY_GATE_P99 = "p99_non_increasing"
LEGACY_GATE_ROW_LOSS = "drop_ratio_ok"
DECISION_APPROVED = "APROVADO para aplicar"
DECISION_REVIEW = "NECESSITA REVISÃO"

# --- fixed values: labels of the before/after table -------------------------
METRIC_LABELS = (
    ("n", "Linhas", 0),
    ("dup_est", "Duplicatas estimadas", 0),
    ("n_price_zero_or_null", "`unit_price` <= 0 ou nulo", 0),
    ("n_channel_off_domain", "Canal fora do domínio", 0),
    ("n_missing_customer", "`customer_id` ausente", 0),
    ("n_channel_labels", "Rótulos distintos de canal", 0),
    ("p01", "P01 de `unit_price`", 2),
    ("p99", "P99 de `unit_price`", 2),
)

# --- fixed values: SQL text guardrails (pattern, message) -------------------
# SQL_HINTS holds, for patterns that start with a keyword, lower-case pieces of
# which a matching text must contain at least one.  (No piece has an i, k or s:
# letters with relatives outside ASCII that match them when case is ignored.)
BLOCKED_SQL = (
    (r"\bDROP\s+(TABLE|VIEW|SCHEMA)\s+(?!IF\s+EXISTS\s+gold\.)(raw|stg)\.", "DROP em raw/stg"),
    (r"\bALTER\s+(TABLE|SCHEMA)\s+(raw|stg)\.", "ALTER em raw/stg"),
    (r"\bUPDATE\s+(raw|stg)\.", "UPDATE em raw/stg"),
    (r"\bDELETE\s+FROM\s+(raw|stg)\.", "DELETE em raw/stg"),
    (
        r"\b(ATTACH|DETACH|VACUUM|PRAGMA|INSTALL|LOAD|COPY\s+\(?\s*SELECT.*\)?\s*TO\s+'/)\b",
        "comando fora do escopo",
    ),
    (r"\bCREATE\s+(OR\s+REPLACE\s+)?(TABLE|VIEW)\s+(raw|stg)\.", "CREATE em raw/stg"),
)
REQUIRED_SQL = (
    (
        r"\bCREATE\s+OR\s+REPLACE\s+TABLE\s+gold\.sales_clean\b",
        "CREATE OR REPLACE TABLE gold.sales_clean",
    ),
    (r"\bROW_NUMBER\s*\(\s*\)\s*OVER", "deduplicação via ROW_NUMBER()"),
)
SQL_HINTS = {
    "DROP em raw/stg": ("drop",),
    "ALTER em raw/stg": ("alter",),
    "UPDATE em raw/stg": ("update",),
    "DELETE em raw/stg": ("delete",),
    "comando fora do escopo": ("tach", "vacuum", "pragma", "tall", "load", "copy"),
    "CREATE em raw/stg": ("create",),
    "DROP IF EXISTS em raw/stg": ("drop",),
    "TRUNCATE em raw/stg": ("truncate",),
    "MERGE em raw/stg": ("merge",),
    "INSERT em raw/stg": ("ert",),
}
UNKNOWN_SQL_COLUMNS = ("created_at", "updated_at", "ingested_at")
CHANNEL_ALIAS_SQL = r"\bAS\s+channel\b"
BARE_CHANNEL_SQL = r"(?<![_.\w])channel(?![_\w])"
BARE_CHANNEL_MESSAGE = "channel (na staging use channel_norm ou channel_raw)"

# Stricter rules of our own, only used on request.
EXTRA_BLOCKED_SQL = (
    (r"\bDROP\s+(TABLE|VIEW|SCHEMA)\s+IF\s+EXISTS\s+(raw|stg)\b", "DROP IF EXISTS em raw/stg"),
    (r"\bTRUNCATE\s+(TABLE\s+)?(raw|stg)\.", "TRUNCATE em raw/stg"),
    (r"\bMERGE\s+INTO\s+(raw|stg)\.", "MERGE em raw/stg"),
    (r"\bINSERT\s+(INTO|OVERWRITE)\s+(TABLE\s+)?(raw|stg)\.", "INSERT em raw/stg"),
)

# --- fixed values: text artifacts -------------------------------------------
# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
FENCE = "```"
FENCE_LANGUAGE = "[a-zA-Z0-9_+-]*"
MAX_FENCE_LAYERS = 3
REQUIRED_ARTIFACT_KEYS = {
    "reports/plan.json": ("tasks",),
    "reports/analysis_findings.json": ("findings", "notes"),
    "reports/validation_report.json": ("syntax_ok", "blocked_commands", "before_after"),
}
FINDINGS_ARTIFACT = "analysis_findings.json"
FINDING_KEYS = ("problem", "evidence", "business_impact", "priority")
NO_JSON_MESSAGE = "Nenhum JSON válido encontrado na saída do agente."
MISSING_FILE_MESSAGE = "arquivo não gerado"
EMPTY_FILE_MESSAGE = "conteúdo vazio"
READONLY_MESSAGE = "Apenas SELECT/WITH são permitidos nesta ferramenta."
READONLY_ROWS = 50
SAMPLE_ROWS = 5

# --- fixed values: fallback record ------------------------------------------
FALLBACK_REASON_FAILED = "patch gerado pelo agente não executou em dry-run"
FALLBACK_REASON_MISSING = "patch do agente não foi gerado"
