"""That the methods decide something: fitted bands, converging scores, whole values, spans of the output."""

import collections
import random
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from clearbrook.llm import chat, pii, quality, secretscan
from clearbrook.llm.common import ship
from tests.llm.cases import documents

# --- quality --------------------------------------------------------------------


def test_fitted_bands_reject_what_labels_call_bad(spark):
    """On labelled documents that the fit has not seen, beyond what the base rule rejects."""
    ship(spark)
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    bands = quality.fit_bands(docs, labels)
    fresh = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % quality.FOLDS == 0)
    judged = quality.quality_report(docs, bands).join(fresh, "doc_id").where("NOT base_failed").select("kept", "quality", "reason").collect()
    good, bad = ([r for r in judged if r["quality"] == q] for q in (1, 0))
    rejected = [r for r in judged if not r["kept"]]
    assert len(bad) > 30 and len(good) > 400
    assert sum(not r["kept"] for r in bad) / len(bad) > 0.6  # recall
    assert sum(r["quality"] == 0 for r in rejected) / len(rejected) > 0.8  # precision
    assert sum(r["kept"] for r in good) / len(good) > 0.98
    assert all(r["reason"] for r in rejected)


def test_bands_without_labels_are_the_wide_ones(spark):
    ship(spark)
    for labels in ([], [(1, 0), (5, 0)], [(1, None)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        assert quality.fit_bands(documents(spark), frame) == quality.BANDS
    few = quality.fit_bands(documents(spark), spark.createDataFrame([(1, 1), (5, 1), (8, 1), (8, 0)], "doc_id long, quality int"))
    assert all(quality.band_of(size, few) == quality.band_of(size) for size in (10, 300, 1100, 5000, 1 << 20))


def test_bands_come_from_every_good_document(spark):
    """More documents than any sample: the outer quantiles are those of all, but for the fold."""
    pick = random.Random(3)
    texts = [" ".join(f"{pick.randrange(10 ** pick.randrange(1, 9)):x}" for _ in range(60))[:300].ljust(300, "x") for _ in range(7000)]
    bands = quality.fit_bands(documents(spark, list(enumerate(texts))), spark.range(7000).selectExpr("id AS doc_id", "1 AS quality"))
    compressor = zstandard.ZstdCompressor(level=quality.LEVEL)
    ratios = [len(compressor.compress(t.encode())) / 300 for k, t in enumerate(texts) if zlib.crc32(str(k).encode()) % quality.FOLDS ]
    assert len(ratios) > 5000
    least, most = np.quantile(ratios, [quality.FIT_SHARE, 1 - quality.FIT_SHARE])
    wide = quality.band_of(300)
    expected = max(wide[0], least - quality.FIT_MARGIN), max(wide[1], most + quality.FIT_MARGIN)
    assert quality.band_of(300, bands) == pytest.approx(expected) and expected != wide


# --- personal data ------------------------------------------------------------------


def test_a_labelled_value_is_taken_whole(spark):
    value = "A1" * 80 + "Z"
    rows = [(k, f"Write or call. Phone no: +1 (555) 10{k}-4567 today") for k in range(6)] + [(10, f"Write or call. Phone no: {value} today")]
    found = {r["doc_id"]: r["spans"] for r in pii.personal_data(documents(spark, rows)).collect()}
    start = rows[-1][1].index(value)
    assert found[10] == f"like_phone:{start}:{start + len(value)}"


def _plain_scores(labels):
    """The same scoring on dictionaries, until nothing changes."""
    edges = {}
    for pattern, value, kind, seed in labels:
        known, alike = edges.get((pattern, (seed or value).lower()), (None, False))
        edges[pattern, (seed or value).lower()] = (max(filter(None, (known, kind)), default=None), alike or any(c in "0123456789@" for c in value))
    seeds = {instance for (_, instance), (kind, _) in edges.items() if kind}
    values = {instance: float(instance in seeds) for _, instance in edges}
    patterns = None
    while True:
        sums = collections.defaultdict(lambda: [0.0, 0, collections.Counter()])
        for (pattern, instance), (kind, _) in edges.items():
            sums[pattern][0] += values[instance]
            sums[pattern][1] += 1
            sums[pattern][2][kind] += kind is not None
        now = {
            p: (max(pii.KINDS, key=lambda k: (kinds[k], [-ord(c) for c in k])), round(known / n, 6))
            for p, (known, n, kinds) in sums.items() if known >= pii.SUPPORT and known / n >= pii.PATTERN_SCORE
        }
        if now == patterns:
            return patterns
        patterns = now
        for instance in values:
            wrong = 1.0
            leading = [p for (p, i), (_, alike) in edges.items() if i == instance and alike and p in now]
            for p in leading:
                wrong *= 1 - min(sums[p][0] / sums[p][1], 0.99)
            if instance not in seeds:
                values[instance] = 1 - wrong if leading and 1 - wrong >= pii.VALUE_SCORE else 0.0


def test_scores_equal_a_plain_version_and_go_on_until_they_settle(spark):
    """A chain in which each pattern becomes good only by the values of the one before: more turns than three."""
    labels = [("p0", f"s{k}@x", "email", f"s{k}@x") for k in range(9)] + [("p0", "v0-1", None, None)]
    for step in range(1, 7):
        # Half of a pattern's values are those that the pattern before it has found.
        labels += [(f"p{step - 1}", f"c{step}{k}-7", None, None) for k in range(3)]
        labels += [(f"p{step - 1}", f"k{step}{k}@y", "email", f"k{step}{k}@y") for k in range(7)]
        labels += [(f"p{step}", f"c{step}{k}-7", None, None) for k in range(3)] + [(f"p{step}", f"new{step}-1", None, None)]
    labels += [("bad", f"b{k}", None, None) for k in range(20)] + [("bad", "s1@x", "email", "s1@x")]
    frame = spark.createDataFrame(labels, "pattern string, value string, seed_kind string, seed_value string")
    found = {r["pattern"]: (r["kind"], round(r["score"], 6)) for r in pii.score_patterns(frame).collect()}
    assert found == _plain_scores(labels) and len(found) >= 6 and "bad" not in found


# --- secrets ------------------------------------------------------------------------


def test_long_logins_and_key_names_are_found(spark):
    rows = [(1, "see https://" + "u" * 300 + ":" + "p" * 300 + "@host/x"), (2, "-----BEGIN " + "VERY " * 20 + "PRIVATE KEY-----"), (3, "https://a:b c@d")]
    found = {r["doc_id"]: r["spans"] for r in secretscan.secret_scan(documents(spark, rows)).collect()}
    assert found[1].startswith("url_login:4:") and found[2].startswith("private_key:0:") and found[3] == ""


# --- chats --------------------------------------------------------------------------


@pytest.mark.parametrize("shift", [0, 1, -1])
def test_a_shifted_span_fails_the_digest(spark, shift):
    rows = spark.createDataFrame([(1, 0, "user", "aa"), (1, 1, "assistant", "same same"), (1, 2, "assistant", "<|im_end|>\n")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_chats(chat.turns_of_table(rows, "conv_id", "turn", fields=("role", "text")), "conv_id", "turn")
    moved = formatted.withColumn("spans", F.transform("spans", lambda s: F.struct((s["start"] + shift).alias("start"), (s["stop"] + shift).alias("stop"), s["loss"].alias("loss"))))
    back = chat.read_back(moved, "conv_id").first()
    assert (back["loss_chars"] == len("same same<|im_end|>\n")) == (shift == 0)


def test_chats_of_empty_tables_and_clashing_columns(spark):
    schema = "conv_id long, turn long, role string, text string, formatted string, spans string, turns int, __order int, loss int"
    rows = spark.createDataFrame([(1, 0, "user", "a", "x", "y", 1, 2, 3), (1, 1, "assistant", "b", "x", "y", 1, 2, 3)], schema)
    for table, n in ((rows, 1), (rows.where("false"), 0)):
        turns = chat.turns_of_table(table, "conv_id", "turn", fields=("role", "text"))
        found = chat.read_back(chat.format_chats(turns, "conv_id", "turn"), "conv_id").collect()
        assert [r["loss_chars"] for r in found] == [1] * n
