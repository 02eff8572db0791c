"""Near copies of a stated similarity: recall by brute force, exact verification, hot signatures."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearbrook.llm import nearcopies
from clearbrook.llm.common import ship
from clearbrook.llm.components import components
from tests.llm.cases import ROWS, documents

WORDS = [f"w{k}" for k in range(30000)]


def copy_with_changes(pick, words, similarity):
    """A copy in which so many words are other ones that about that share of the five-word shingles is left in the union."""
    changed = round((len(words) - 4) * (1 - similarity) / (5 * (1 + similarity)))
    copy = list(words)
    for k in pick.sample(range(5, len(words) - 5), changed):
        copy[k] = f"z{pick.random()}"
    return copy


def jaccard(a, b):
    a, b = (set(zip(*[t.lower().split()[k:] for k in range(5)])) for t in (a, b))
    return len(a & b) / len(a | b)


def test_shingles_are_those_of_the_words():
    text = "A b c d e F g\ta b c d e"
    assert len(nearcopies.shingles(text)) == len({tuple(text.lower().split()[k : k + 5]) for k in range(8)})
    assert len(nearcopies.shingles("one two")) == 1 and len(nearcopies.shingles(" \n")) == len(nearcopies.shingles(None)) == 0
    assert (nearcopies.shingles("one two") == nearcopies.shingles(" ONE\ttwo ")).all()


@pytest.fixture(scope="module")
def planted(spark):
    """Pairs at three similarities, and what became of each."""
    ship(spark)
    pick, rows, pairs = random.Random(11), [], {}
    for similarity in (0.82, 0.91, 0.95):
        for _ in range(60):
            words = [pick.choice(WORDS) for _ in range(pick.choice([150, 400, 900]))]
            i = len(rows)
            rows += [(i, " ".join(words)), (i + 1, " ".join(copy_with_changes(pick, words, similarity)))]
            pairs[i] = jaccard(rows[i][1], rows[i + 1][1])
    rows += [(len(rows) + k, " ".join(pick.choice(WORDS) for _ in range(200))) for k in range(60)]
    kept = {r["doc_id"] for r in nearcopies.keep_one(documents(spark, rows)).collect()}
    return rows, pairs, kept


def test_recall_on_pairs(planted):
    rows, pairs, kept = planted
    found = lambda low, high: [i + 1 not in kept for i, s in pairs.items() if low <= s < high]
    for low, high, least in ((0.9, 0.94, 0.85), (0.94, 1.0, 0.97), (0.8, 0.9, 0.4)):
        hits = found(low, high)
        assert len(hits) > 20 and sum(hits) / len(hits) >= least, (low, sum(hits) / len(hits))


def test_nothing_below_the_similarity_goes(planted):
    rows, pairs, kept = planted
    assert all(i in kept for i in range(0, 360, 2)) and all(i in kept for i, _ in rows[360:])
    assert all(i + 1 in kept for i, s in pairs.items() if s < nearcopies.SIMILARITY)


def test_links_equal_all_pairs_with_a_common_signature(spark):
    """Whatever shares a signature and is similar enough is connected, through hot signatures too."""
    ship(spark)
    pick = random.Random(2)
    base = [pick.choice(WORDS) for _ in range(300)]
    texts = [" ".join(copy_with_changes(pick, base, s)) for s in [0.97] * 40 + [0.9] * 10]  # one crowd of near copies
    texts += [" ".join(pick.choice(WORDS) for _ in range(60)) for _ in range(30)]
    docs = documents(spark, list(enumerate(texts)))
    prints = nearcopies.fingerprints(docs).collect()
    nodes = nearcopies.keep(
        nearcopies.fingerprints(docs).select("u", "segments", F.struct(F.lit(False).alias("unnamed"), "doc_id", "digest").alias("first")), "nodes"
    )
    roots = {r["u"]: r["root"] for r in components(nearcopies.links(nodes, docs)).collect()}
    name = {r["doc_id"]: r["u"] for r in prints}
    segments = {r["doc_id"]: np.array(r["segments"]) for r in prints}
    linked = 0
    for a, b in itertools.combinations(range(len(texts)), 2):
        near = min(bin(int(x)).count("1") for x in segments[a] ^ segments[b]) <= 1
        if near and jaccard(texts[a], texts[b]) >= nearcopies.SIMILARITY:
            linked += 1
            assert roots.get(name[a], name[a]) == roots.get(name[b], name[b])
    assert linked > 300
    for a, b in itertools.combinations(range(50, len(texts)), 2):
        assert roots.get(name[a], name[a]) != roots.get(name[b], name[b])


def test_edge_rows_and_copies(spark):
    ship(spark)
    kept = nearcopies.keep_one(documents(spark)).collect()
    assert len(kept) == len({(r["doc_id"], r["text"]) for r in kept})
    assert {r["doc_id"] for r in kept} == {1, 2, 5, 6, 8, 9, None}  # 2, 3, 4 are empty; 6 and 7 are equal; one row has no id
    many = documents(spark, [(k, "the very same text of all of these many rows here") for k in range(500)] + [(1000, ROWS[0][1])])
    assert sorted(r["doc_id"] for r in nearcopies.keep_one(many).collect()) == [0, 1000]
    assert nearcopies.keep_one(documents(spark, []).where("false")).collect() == []
    assert nearcopies.keep_one(documents(spark)).columns == documents(spark).columns


def groups_of(pairs, n):
    """The smallest number of each one's group."""
    roots = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            roots[a] = roots[b] = min(roots[a], roots[b])
    return roots


def test_no_pair_that_meets_the_similarity_is_left_out(spark):
    """Groups are those of all pairs: around the threshold, over others, among copies, with common and with few shingles."""
    ship(spark)
    pick = random.Random(5)
    texts = []
    for similarity in (0.8, 0.82, 0.85):
        for size in (12, 40, 200, 500):
            for _ in range(8):
                words = [pick.choice(WORDS) for _ in range(size)]
                texts += [" ".join(words), " ".join(copy_with_changes(pick, words, similarity))]
                texts.append(" ".join(words[: round(size * similarity) + 2]))  # a part of it
    words = [pick.choice(WORDS) for _ in range(300)]
    for _ in range(40):  # each a copy of the one before, the ends unlike
        texts.append(" ".join(words))
        words = copy_with_changes(pick, words, 0.83).copy()
    lines = [" ".join(pick.choice(WORDS) for _ in range(12)) for _ in range(20)]
    texts += [" ".join(pick.sample(lines, 9)) for _ in range(60)]  # made of what others have too
    texts += texts[:5] + ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g", "a", "a b"]
    pick.shuffle(texts)
    sets = [frozenset(nearcopies.shingles(t).tolist()) for t in texts]
    pairs = [
        (a, b) for a, b in itertools.combinations(range(len(sets)), 2)
        if len(sets[a] & sets[b]) >= nearcopies.SIMILARITY * len(sets[a] | sets[b])
    ]
    roots = groups_of(pairs, len(sets))
    assert len(pairs) > 150 and len(set(roots)) > 100
    kept = {r["doc_id"] for r in nearcopies.keep_one(documents(spark, list(enumerate(texts)))).collect()}
    assert kept == set(roots)
