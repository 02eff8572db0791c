"""What holds for every operator: edge rows, empty tables, extra columns, stages of the pipeline."""

import pytest

import corpus_pipeline
from clearbrook.llm import decontaminate, licenses, packing, pii, quality, repeats, secretscan, simhash, tokencount
from tests.llm.cases import ROWS, documents

PER_DOCUMENT = {
    "secrets": secretscan.secret_scan, "simhash": simhash.near_duplicates, "licenses": licenses.license_scan,
    "repeats": repeats.line_dedup, "tokens": tokencount.token_counts, "quality": quality.quality_report, "pii": pii.personal_data,
    "decontaminate": lambda docs: decontaminate.decontamination_report(docs, documents(docs.sparkSession).withColumnRenamed("doc_id", "item_id")),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document_whatever_it_holds(name, spark):
    found = PER_DOCUMENT[name](documents(spark)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((i is None, i or 0) for i, _ in ROWS)
    twins = [tuple(r) for r in found if r["doc_id"] == 6]
    assert len(twins) == 2 and twins[0] == twins[1]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_empty_table(name, spark):
    assert PER_DOCUMENT[name](documents(spark, []).where("false")).collect() == []


def test_stages_keep_columns_and_stand_edge_rows(spark, tmp_path):
    documents(spark).selectExpr("doc_id as item_id", "text").where("item_id = 1").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (ROWS, []):
        docs = documents(spark, ROWS).where("true" if rows else "false")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, str(tmp_path))
            assert after.columns == docs.columns
            after.collect()
        sequences = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert bool(sequences) == bool(rows)


def test_pieces_of_edge_rows(spark):
    found = packing.pack(documents(spark)).collect()
    firsts = [r for r in found if r["start"] == 0]
    assert len(firsts) == len(ROWS)
    assert sorted(r["doc_tokens"] for r in firsts)[:3] == [1, 1, 1]  # null and empty texts are the closing id alone
