"""Toxicity: held-out accuracy, new spellings, edge rows."""

import zlib

import numpy as np
import pytest

from clearbrook.llm import toxicity
from clearbrook.llm.common import ship
from tests.llm.cases import ROWS, documents


@pytest.fixture(scope="module")
def scored(spark):
    """All documents of the larger tables, with their labels where they have one."""
    ship(spark)
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    return [(r, known.get(r["doc_id"])) for r in toxicity.toxicity(docs, labels).collect()]


def test_held_out_accuracy(scored):
    pairs = [(r["score"], y) for r, y in scored if r["held_out"] and y is not None]
    toxic, clean = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    better = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert better > 0.95  # about a tenth of the labels is noise on texts of junk
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.8
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.04


def test_folds_and_ranges(scored):
    for r, _ in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_new_spellings_share_vectors():
    clean = "the lamp stood near a window while rain fell over quiet streets and people walked slowly home past shops that sold bread".split()
    samples = []
    for k in range(400):
        words = [clean[(k * 7 + n * n) % len(clean)] for n in range(toxicity.WINDOW)]
        if k % 3 == 0:
            words[k % len(words)] = ("blockhead", "scoundrel", "nincompoop")[k // 3 % 3]
        samples.append(([" ".join(words)], int(k % 3 == 0)))
    model = toxicity.fit(samples)
    frame = " ".join(clean[:8])
    assert model.score(f"{frame} {frame}") < 0.5
    for word in ("blockhead", "scoundrel", "blokhead", "blockheads", "scoundrell", "nincompooop"):
        assert model.score(f"{frame} {word} {frame}") > 0.5, word


def test_a_long_text_is_as_toxic_as_its_worst_window():
    samples = [([" ".join(["good", "day", "dear", "friends", "of", "mine"][: 3 + k % 4] + ["villain"] * (k % 2))], k % 2) for k in range(200)]
    model = toxicity.fit(samples)
    assert model.score("good day dear friends " * 3000) < 0.5 < model.score("good day dear friends " * 1500 + "villain " + "good day dear friends " * 1500)


def test_edge_rows(spark):
    ship(spark)
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (5, 1, 0), (6, None, 0), (None, 1, 1), (8, 0, 0), (77, 1, 1)], "doc_id long, toxic int, quality int")
    found = toxicity.toxicity(documents(spark), labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == sorted((i is None, i or 0) for i, _ in ROWS)
    twins = [tuple(r) for r in found if r["doc_id"] == 6]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert len({r["score"] for r in found if r["doc_id"] in (2, 3, 4)}) == 1
    assert all(r["held_out"] for r in found if r["doc_id"] is None)


@pytest.mark.parametrize("kind", [None, 0, 1])
def test_without_two_kinds_of_labels(kind, spark):
    ship(spark)
    labels = spark.createDataFrame([] if kind is None else [(1, kind), (5, kind), (7, kind)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(documents(spark), labels).collect()} == {float(kind or 0)}


def test_empty_table(spark):
    ship(spark)
    assert toxicity.toxicity(documents(spark, []).where("false"), spark.createDataFrame([], "doc_id long, toxic int")).collect() == []


def test_words_looked_up_together_have_the_sums_of_their_subwords(monkeypatch):
    """One call for many words, as a call for each took most of the time; repeated n-grams count once, also beyond ASCII."""
    parts = np.random.default_rng(2).normal(size=toxicity.ROWS).astype(np.float32)
    words = ["a", "ab", "abc", "aaaaaaaaaa", "xyxyxyxyxy", "<>", "!!!", "über", "naïve", "日本語", "zebra", "12345678901234567890"]
    totals, counts = toxicity.bag_sums(words, parts)
    bags = [toxicity.subwords(w) for w in words]
    assert counts.tolist() == [len(b) for b in bags]
    assert totals.tolist() == pytest.approx([float(parts[b].sum(dtype=np.float64)) for b in bags], abs=1e-9)
    assert all(len(a) == 0 for a in toxicity.bag_sums([], parts))
    monkeypatch.setattr(toxicity, "REMEMBERED", 5)  # forgets, and takes more than that where one batch has more
    model = toxicity.Model(0.1, np.ones((toxicity.ROWS, 2), np.float32) * parts[:, None], np.ones(2, np.float32))
    texts = ["a b c", "d e f", None, "a b c d e f g h", "c"]
    alone = [toxicity.Model(0.1, np.ones((toxicity.ROWS, 2), np.float32) * parts[:, None], np.ones(2, np.float32)).score(t) for t in texts]
    assert [model.score(t) for t in texts] == alone == model.scores(texts) and alone[2] == 0.1
