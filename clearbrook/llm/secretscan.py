"""Secret scans over a trigram inverted index.

Each rule's expression yields a Boolean query over trigrams. Documents are indexed by those trigrams; intersecting the
posting lists of a query gives the documents that may match, and only those meet the rule's expression. Rules without
a mandatory trigram scan every text. Everything is built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearbrook.llm.common import ID, SPANS, TEXT, find, keep, no_spans, of_kind, span_text, spans_of, texts
from clearbrook.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group whose length decides, and how long it must be.
    group: int = 0
    least: int = 0


# The base kinds. A run that is long enough is found by its least length, as shorter ones never count.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Further kinds: formats that issuers document, each with a fixed beginning.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"Bearer [A-Za-z0-9._~+/-]{24,}"),
    Rule("url_login", r"(?:https?|ftp|mysql|redis|amqps?|postgres|postgresql|mongodb)://[^\s:@/]+:[^\s:@/]+@"),
)
RULES = BASE + MORE


def _folded(text: Column) -> Column:
    return F.lower(text)


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: which slot's documents contain which of the trigrams, each pair once, ordered by trigram."""
    found = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in trigrams]))
    rows = docs.select("slot", _folded(F.col(TEXT)).alias("folded")).select("slot", F.explode(found).alias("trigram"))
    return rows.distinct().sortWithinPartitions("trigram")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(slot, rules): the numbers of the rules whose whole query the slot's postings fulfil."""
    rows = [
        (number, clause_no, set_no, trigram, len(trigrams), len(query))
        for number, query in ((n, trigram_query(r.pattern)) for n, r in enumerate(rules))
        for clause_no, clause in enumerate(query)
        for set_no, trigrams in enumerate(sorted(clause, key=sorted))
        for trigram in sorted(trigrams)
    ]
    values = ", ".join(f"({n}, {c}, {s}, '{t.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}', {size}, {parts})" for n, c, s, t, size, parts in rows)
    query = index.sparkSession.sql(f"SELECT * FROM VALUES {values} AS q(rule, clause, choice, trigram, size, clauses)")
    whole = (
        index.join(F.broadcast(query), "trigram")  # as many rows as the rules have trigrams
        .groupBy("slot", "rule", "clause", "choice").agg(F.count("*").alias("n"), F.first("size").alias("size"), F.first("clauses").alias("clauses"))
        .where(F.col("n") == F.col("size"))
    )
    met = whole.groupBy("slot", "rule").agg(F.countDistinct("clause").alias("n"), F.first("clauses").alias("clauses"))
    return met.where(F.col("n") == F.col("clauses")).groupBy("slot").agg(F.collect_set("rule").alias("rules"))


def secret_scan(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """One row per document: counts and digest of the base kinds, and all spans.

    A null or empty text has no spans, so the digest is that of the empty string. Documents are indexed by a slot, the
    hash of their id; documents that share one, also all those without an id, share candidates, never matches. Equal
    rows get equal rows.
    """
    rules = BASE + more
    spark = docs.sparkSession
    queries = [trigram_query(r.pattern) for r in rules]
    vocabulary = sorted({t for query in queries for clause in query for choice in clause for t in choice})
    source = texts(docs).select(ID, TEXT, F.xxhash64(ID).alias("slot"))
    index = keep(postings(source, vocabulary), "postings")
    # The written table's size is known to the planner, which broadcasts it only below its threshold.
    chosen = keep(candidates(index, rules), "candidates")
    checked = source.join(chosen, "slot", "left")

    searches = {
        rule.kind: (rule.pattern, rule.group, F.array_contains("rules", rank) if query else None)
        for rank, (rule, query) in enumerate(zip(rules, queries))
    }

    def long_enough(rule: Rule) -> Column:
        return F.filter(rule.kind, lambda x: F.length(x["value"]) >= rule.least) if rule.least else F.col(rule.kind)

    spans = [F.coalesce(spans_of(long_enough(r), rank, r.kind).cast(SPANS), no_spans()) for rank, r in enumerate(rules)]
    checked = find(checked, TEXT, searches).select(ID, F.concat(*spans).alias("found"))
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return checked.select(
        ID,
        *[of_kind(F.col("found"), r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"),
    )
