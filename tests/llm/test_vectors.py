"""Hard negatives: exact scores, and the whole result against every pair."""

import math

import numpy as np
import pytest

import __spark_entry__ as contract
from clearbrook.llm import hardnegatives, queries, residues
from clearbrook.llm.common import ship


@pytest.mark.parametrize("size", [1, 300, 2**20, 2**27, 2**31, 2.0**60, 2.0**130])
@pytest.mark.parametrize("width", [0, 1, 64, 131])
def test_scores_are_exact(size, width):
    chance = np.random.default_rng(width)
    left, right = (np.floor((chance.random((n, width)) - 0.5) * 2 * size) for n in (5, 7))
    left[0], right[0] = size, -size  # the largest there is
    most = residues.LARGEST
    exact = [[max(-most, min(most, sum(int(x) * int(y) for x, y in zip(a, b)))) for b in right] for a in left]
    assert residues.scores(left, right).tolist() == exact


def test_products_stay_exact_in_float32():
    assert residues.SLAB * (max(residues.PRIMES) // 2) ** 2 < 1 << 24
    assert all(math.gcd(a, b) == 1 for a in residues.PRIMES for b in residues.PRIMES if a < b)


def _plain(rows, positives=5, negatives=10):
    """Every anchor with every row, in Python's integers."""
    usable = [(i, (y + 1) % 10 if i is not None and i % 7 == 0 else y, [math.floor(256 * x) for x in v]) for i, v, y in rows
              if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    found = []
    for anchor, label, cells in {repr(u): u for u in usable if u[0] is not None and u[0] % 100 == 0}.values():
        scored = [(sum(a * b for a, b in zip(cells, other)), i, y) for i, y, other in usable]
        mine = sorted(((s, i) for s, i, y in scored if y == label and i != anchor), key=order)[:positives]
        for positive, name in mine:
            hard = sorted(((s, i) for s, i, y in scored if y != label and 30 * positive <= 100 * s <= 90 * positive), key=order)
            found += [(anchor, name, k + 1, i, positive, s) for k, (s, i) in enumerate(hard[:negatives])]
    return found


SCHEMA = "vec_id long, embedding array<float>, label int, score double, slot int, list int, cells string, rank int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, y, 0.0, 0, 0, "x", 0) for i, v, y in rows], SCHEMA).repartition(5)


def _mined(spark, rows):
    ship(spark)
    from pyspark.sql import functions as F

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    ready = hardnegatives.prepared(_frame(spark, rows).withColumn("label", label))
    return sorted(map(tuple, hardnegatives.hard_negatives(ready, ready.where("vec_id % 100 = 0")).collect()), key=repr)


def _vectors(n=700, width=9, seed=3):
    chance = np.random.default_rng(seed)
    centres = chance.normal(0, 0.3, (10, width))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 10] + chance.normal(0, 0.2, width)], int(chance.integers(0, 10))) for i in range(n)]
    rows += [(n + k, rows[5][1], k % 10) for k in range(200)]  # a third of the rows are one vector: ties by id
    return rows


def test_equals_every_pair(spark, monkeypatch):
    rows = _vectors()
    monkeypatch.setattr(hardnegatives, "SENT", 1)  # each block of anchors in a pass of its own
    monkeypatch.setattr(hardnegatives, "ANCHORS", 3)
    assert _mined(spark, rows) == sorted(_plain(rows), key=repr)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = _vectors(150, 4) + [
        (200, [nan, 0.0, 0.0, 0.0], 1), (300, [inf, 0.0, 0.0, 0.0], 1), (301, [None, 0.5, 0.5, 0.5], 2), (400, None, 3), (500, [0.1] * 4, None),
        (None, [0.3, 0.3, 0.2, 0.1], 4), (None, [0.3, 0.3, 0.2, 0.1], 5), (100, [0.2, 0.4, 0.1, 0.3], 5), (100, [0.2, 0.4, 0.1, 0.3], 5),
        (600, [0.5, 0.5, 0.5, 0.5], 6), (601, [0.5, 0.5, 0.5, 0.5], 6), (602, [0.3, 0.3, 0.3, 0.3], 7), (602, [0.3, 0.3, 0.3, 0.3], 7),
        (700, [0.5], 8), (701, [], 8), (702, [0.4, 9.0, 9.0, 9.0], 8), (800, [0.0] * 4, 9), (801, [1e30, 0.0, 0.0, 0.0], 9),
    ]
    def filled(v):
        return v if v is None else v + [0.0] * (4 - len(v))
    rows_even = [(i, filled(v), y) for i, v, y in rows]
    plain = _plain(rows_even)
    most = residues.LARGEST
    plain = [(a, p, k, n, max(-most, min(most, s)), max(-most, min(most, t))) for a, p, k, n, s, t in plain]
    assert _mined(spark, rows) == sorted(plain, key=repr)


def test_empty_tables(spark):
    assert _mined(spark, []) == []
    assert _mined(spark, [(1, [0.5], 1), (2, [0.5], 1)]) == []


def test_query_equals_sql(spark, folder, duck):
    rows = sorted(map(tuple, queries.QUERIES["op11_hard_negatives"](spark, folder).collect()))
    assert rows and rows == sorted(duck.sql(contract.oracle_sql()["op11_hard_negatives"]).fetchall())
