import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearbrook.fixed_values import REQUIRED_ARTIFACT_KEYS
from clearbrook.functions.artifacts import (
    SchemaError, artifact_violations, extract_json, sanitize, sanitize_strictly, strip_fences,
)

FINDINGS, PLAN, VALIDATION = "reports/analysis_findings.json", "reports/plan.json", "reports/validation_report.json"


def column(spark, texts, expression):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["r"] for r in frame.select("i", expression(F.col("t")).alias("r")).orderBy("i").collect()]


FENCES = [
    ("```sql\nVALUES (2)\n```", "VALUES (2)"), ("  SELECT 1;\n", "SELECT 1;"), (None, ""), ("", ""), ("```\n```", ""),
    ("```json\n```sql\n```\nx\n```\n```\n```", "x"), ("```a\n```b\n```c\n```d\nx\n```\n```\n```\n```", "```d\nx\n```"),
    ("```json {}```", "```json {}```"), ("````\nx\n````", "````\nx\n````"), ("```c++ \n\n  x  \n\n```\u00a0", "x"),
    ("text ```\nx\n```", "text ```\nx\n```"), ("```\nx\n``` tail", "```\nx\n``` tail"), ("\x1f\u3000x\x85", "x"), ("```", "```"),
    ("```\n", "```"), ("```sql\nx```", "x"), ("```a b\nx\n```", "```a b\nx\n```"),
]


def test_fences(spark):
    assert column(spark, [t for t, _ in FENCES], strip_fences) == [want for _, want in FENCES]


JSON = [
    ('```json\n{"rows": [3], "ok": true}\n```', {"rows": [3], "ok": True}),
    ('Below:\n```json\n{"steps": [{"no": 7}]}\n```\nregards', {"steps": [{"no": 7}]}),
    ('{"a":1} tail', {"a": 1}), ('[{"a":1},{"b":2}] x', {"a": 1}), ('[{"a":1},{"b":2}]', [{"a": 1}, {"b": 2}]),
    ('[1, 2] x', [1, 2]), ("{bad} [3] x", [3]), ('x {"t":"}{\\"]"} y', {"t": '}{"]'}), ("12", 12), (' "s" ', "s"), ("true", True),
    ("{'a': 1}", ...), ("{bad}", ...), ("prose", ...), ("", ...), (None, ...), ("{", ...), ("[1, {]", ...), ("{bad} {\"a\":1}", ...),
    ('{"é": "ü"}', {"é": "ü"}), ('{"n": 1e400, "m": NaN} x', "infinite"),
]


def test_first_json(spark):
    got = column(spark, [t for t, _ in JSON], extract_json)
    for (text, want), found in zip(JSON, got):
        if want is ...:
            assert found is None, text
        elif want == "infinite":
            assert found == '{"n": Infinity, "m": NaN}'
        else:
            assert json.loads(found) == want, text


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10**9, 10**9) | st.text(max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=4), inner, max_size=3), max_leaves=8,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.dictionaries(st.text(max_size=4), json_values, max_size=3), st.sampled_from(["", "a ", "x:\n"])), min_size=1, max_size=20))
def test_json_behind_prose_comes_back(spark, documents):
    texts = [prose + json.dumps(value, ensure_ascii=False) + (" end" if prose else "") for value, prose in documents]
    got = column(spark, texts, extract_json)
    assert [json.loads(g) for g in got] == [value for value, _ in documents]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="`ab \n\t{}", max_size=30), min_size=1, max_size=40))
def test_fences_against_brute_force(spark, texts):
    def brute(text):
        text = text.strip()
        for _ in range(3):
            lines = re.match(r"```[\w+-]*\s*\n", text)
            if not (lines and text.endswith("```")):
                break
            text = text[lines.end():-3].strip()
        return text

    assert column(spark, texts, strip_fences) == [brute(t) for t in texts]


def finding(**change):
    return {"problem": "p", "evidence": {}, "business_impact": "b", "priority": "alta"} | change


VIOLATIONS = [
    (PLAN, {"tasks": []}, []), (PLAN, {}, ["chave obrigatória ausente -> 'tasks'"]),
    (PLAN, [1], ["raiz deveria ser objeto JSON, veio list"]), (PLAN, 3, ["raiz deveria ser objeto JSON, veio int"]),
    (PLAN, 3.5, ["raiz deveria ser objeto JSON, veio float"]), (PLAN, None, ["raiz deveria ser objeto JSON, veio NoneType"]),
    (PLAN, True, ["raiz deveria ser objeto JSON, veio bool"]), (PLAN, "s", ["raiz deveria ser objeto JSON, veio str"]),
    (VALIDATION, {"syntax_ok": 1}, ["chave obrigatória ausente -> 'blocked_commands'", "chave obrigatória ausente -> 'before_after'"]),
    (FINDINGS, {"findings": [finding()], "notes": ""}, []),
    (FINDINGS, {"notes": ""}, ["chave obrigatória ausente -> 'findings'", "'findings' deve ser lista não-vazia"]),
    (FINDINGS, {"findings": [], "notes": ""}, ["'findings' deve ser lista não-vazia"]),
    (FINDINGS, {"findings": {"a": 1}, "notes": ""}, ["'findings' deve ser lista não-vazia"]),
    (FINDINGS, {"findings": "text", "notes": ""}, ["'findings' deve ser lista não-vazia"]),
    (
        FINDINGS, {"findings": [finding(), {"problem": 1, "priority": 2}, "{}", None, [1]], "notes": ""},
        [
            "findings[1] sem chave obrigatória 'evidence'", "findings[1] sem chave obrigatória 'business_impact'",
            "findings[2] não é objeto", "findings[3] não é objeto", "findings[4] não é objeto",
        ],
    ),
    ("other.json", [1], []), ("x/analysis_findings.json", {"findings": 1}, ["'findings' deve ser lista não-vazia"]),
    ("x/analysis_findings.json", [1], []),
]


def test_violations(spark):
    rows = [(i, path, json.dumps(value)) for i, (path, value, _) in enumerate(VIOLATIONS)]
    frame = spark.createDataFrame(rows, "i int, path string, document string")
    got = frame.select("i", artifact_violations("path", "document").alias("p")).orderBy("i").collect()
    for row, (path, value, want) in zip(got, VIOLATIONS):
        assert row["p"] == [f"{path}: {w}" for w in want], value


@pytest.mark.parametrize(
    "path, content, ok, problem, clean",
    [
        (PLAN, None, False, "arquivo não gerado", None), ("a.sql", None, False, "arquivo não gerado", None),
        (PLAN, "prose", False, "Nenhum JSON válido encontrado na saída do agente.", None),
        (PLAN, '```json\n{"tasks": 1}\n```', True, None, '{"tasks": 1}'),
        (PLAN, '{"x": 1}', False, "chave obrigatória ausente -> 'tasks'", '{"x": 1}'),
        ("a.sql", "```sql\nSELECT 1;\n```", True, None, "SELECT 1;"), ("a.md", "```\n \n```", False, "conteúdo vazio", None),
        ("a.md", " ", False, "conteúdo vazio", None),
    ],
)
def test_sanitize(spark, path, content, ok, problem, clean):
    frame = spark.createDataFrame([(path, content)], "path string, content string").withColumn("d", extract_json("content"))
    row = frame.select(sanitize("path", "content", "d").alias("s")).first()["s"]
    assert (row["ok"], row["problems"], row["clean"]) == (ok, [f"{path}: {problem}"] if problem else [], clean)


def test_odd_characters_and_numbers_stop_nothing(spark):
    texts = ['{"a":"\\ud800"}', '{"tasks": NaN}', '{"tasks": "NaN, -Infinity", "b":[-Infinity, 1]}', "[NaN]"]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", extract_json("t").alias("j"))
    found = [r["j"] for r in frame.orderBy("i").collect()]
    assert found == ['{"a": "\\ud800"}', '{"tasks": NaN}', '{"tasks": "NaN, -Infinity", "b": [-Infinity, 1]}', "[NaN]"]
    name, required = next((n, r) for n, r in REQUIRED_ARTIFACT_KEYS.items() if r)
    document = "{" + ", ".join(f'"{k}": NaN' for k in required) + "}"
    problems = spark.createDataFrame([(name, document)], "p string, d string").select(artifact_violations("p", "d").alias("v")).first()["v"]
    assert not any("ausente" in p for p in problems)


def test_strict_sanitizing_names_the_broken_artifacts(spark):
    good = spark.createDataFrame([("notes.txt", "fine")], "path string, content string")
    assert sanitize_strictly(good).collect()[0]["clean"] == "fine"
    with pytest.raises(SchemaError, match="empty.txt"):
        sanitize_strictly(good.union(spark.createDataFrame([("empty.txt", "")], good.schema)))
