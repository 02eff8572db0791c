"""The registered queries of this folder."""

import pytest

import __spark_entry__ as contract
from clearbrook.llm import queries


def test_all_are_registered():
    named = contract.queries()
    assert set(queries.QUERIES) < set(named) and "pipeline" in named
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op11_hard_negatives"}))
def test_queries_return_their_whole_table(name, spark, folder):
    table, key = ("conversations", "conv_id") if name.startswith("op5") else ("documents", "doc_id")
    expected = {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()} | ({-7} if key == "conv_id" else set())
    assert {r[key] for r in queries.QUERIES[name](spark, folder).collect()} == expected


def test_native_plans_have_no_python(spark, folder):
    for name in ("op1_secret_scan", "op3_benchmark_decontamination", "op5_chat_format", "op10_personal_data"):
        plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "InArrow")), name


def test_pipeline_runs(spark, folder):
    rows = contract.queries()["pipeline"](spark, folder).collect()
    docs = {r[0] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()}
    assert rows and {r["doc_id"] for r in rows} < docs
