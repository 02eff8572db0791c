"""The operators of this folder as queries over whole tables, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from clearbrook.llm import (
    alignment, chat, decontaminate, hardnegatives, licenses, packing, pii, quality, repeats, secretscan, simhash, tokencount, toxicity,
)
from clearbrook.llm.common import read, ship


def op1_secret_scan(spark, folder):
    return secretscan.secret_scan(read(spark, folder, "documents"))


def op2_simhash_near_duplicates(spark, folder):
    ship(spark)
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op3_benchmark_decontamination(spark, folder):
    return decontaminate.decontamination_report(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op4_license_scan(spark, folder):
    ship(spark)
    return licenses.license_scan(read(spark, folder, "documents"))


def op5_chat_format(spark, folder):
    """All conversations, and one whose texts are made of control strings."""
    own = spark.sql(
        "SELECT CAST(-7 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)"
    )
    rows = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    turns = chat.turns_of_table(rows, "conv_id", "turn", fields=("role", "text"))
    return chat.read_back(chat.format_chats(turns, "conv_id", "turn"), "conv_id")


def op6_line_dedup(spark, folder):
    ship(spark)
    return repeats.line_dedup(read(spark, folder, "documents"))


def op7_token_counts(spark, folder):
    ship(spark)
    return tokencount.token_counts(read(spark, folder, "documents"))


def op8_quality_rules(spark, folder):
    ship(spark)
    docs = read(spark, folder, "documents")
    return quality.quality_report(docs, quality.fit_bands(docs, read(spark, folder, "labels")))


def op9_packing(spark, folder):
    ship(spark)
    return packing.pack(read(spark, folder, "documents"))


def op10_personal_data(spark, folder):
    return pii.personal_data(read(spark, folder, "documents"))


def op11_hard_negatives(spark, folder):
    """Every hundredth vector against all; every seventh has the label after its own."""
    ship(spark)
    table = read(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hardnegatives.prepared(table.select("vec_id", "embedding", label.alias("label")))
    return hardnegatives.hard_negatives(rows, rows.where("vec_id % 100 = 0"))


def op12_token_alignment(spark, folder):
    ship(spark)
    return alignment.align(read(spark, folder, "documents"))


def op13_toxicity(spark, folder):
    ship(spark)
    return toxicity.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_simhash_near_duplicates, op3_benchmark_decontamination, op4_license_scan, op5_chat_format,
        op6_line_dedup, op7_token_counts, op8_quality_rules, op9_packing, op10_personal_data,
        op11_hard_negatives, op12_token_alignment, op13_toxicity,
    )
}
def _escaped(text: str) -> str:
    for control, written in chat.ESCAPES:
        text = f"replace({text}, '{control}', '{written}')"
    return text


ORACLE_SQL = {
    "op5_chat_format": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum({len(chat.OPEN) + len(chat.CLOSE) + 2} + length(replace({_escaped("role")}, chr(10), '\\n')) + length({_escaped("text")}))::BIGINT AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op11_hard_negatives": f"""
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor({hardnegatives.SCALE} * CAST(x AS DOUBLE))) AS cells
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label, CAST(list_inner_product(a.cells, r.cells) AS BIGINT) AS score
            FROM vectors AS a JOIN vectors AS r ON a.vec_id % 100 = 0 AND r.vec_id IS DISTINCT FROM a.vec_id
        ), positives AS (
            SELECT * FROM scored WHERE own = label
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hardnegatives.POSITIVES}
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
            n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives AS p JOIN scored AS n ON n.anchor_id = p.anchor_id AND n.label <> n.own
            AND 100 * n.score BETWEEN {hardnegatives.LOW} * p.score AND {hardnegatives.HIGH} * p.score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= {hardnegatives.NEGATIVES}
    """,
}
