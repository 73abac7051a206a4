import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from hitloom.llm import negatives

from .conftest import as_sorted, multiset

SCHEMA = "vec_id long, embedding array<double>, label int, slot string, band string, limits int, x string"
OUT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
LONG = 2 ** 63


def brute(rows, every, positives=5, k=10, low=30, high=90):
    whole = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole[i] = min(whole.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in whole.items()}
    out = []
    for a in (i for i in whole if i % every == 0):
        score = {c: max(-LONG, min(LONG - 1, sum(x * y for x, y in zip(whole[a][1], whole[c][1])))) for c in whole if c != a}
        best = sorted(score, key=lambda c: (-score[c], c))
        for p in [c for c in best if whole[c][0] == whole[a][0]][:positives]:
            fits = [c for c in best if whole[c][0] != whole[a][0] and low * score[p] <= 100 * score[c] <= high * score[p]]
            out += [(a, p, r + 1, c, score[p], score[c]) for r, c in enumerate(fits[:k])]
    return as_sorted(out)


def edge_rows(seed):
    rng = random.Random(seed)
    vec = lambda m: [rng.gauss(m, 0.3) for _ in range(8)]
    rows = [(i, vec(0.3 if i % 3 else 0), rng.choice([0, 1, 1, 1, 2])) for i in range(240)]
    rows += [(300 + i, rows[11][1], i % 2) for i in range(60)]  # ties on both sides
    rows += [(400, None, 1), (401, [1.0, None], 1), (402, [float("nan")] * 8, 1), (403, [float("inf")] + [0.0] * 7, 1), (None, [0.1] * 8, 1),
             (410, [0.5] * 8, None), (420, [], 1), (430, [0.2], 2), (440, [0.4] * 11, 1), (450, [-0.5] * 8, 0), (460, [0.0] * 8, 2),
             (10, vec(0.3), 1), (10, vec(0.3), 0), (20, rows[20][1], rows[20][2]), (470, [0.3] * 8, 7)]
    return [(*r, "s", "b", 1, "x") for r in rows]


@pytest.mark.parametrize("anchor_block,row_band,positives,k", [(4096, 262144, 5, 10), (5, 40, 5, 10), (3, 17, 2, 1), (40, 500, 9, 3)])
def test_against_brute_force(spark, anchor_block, row_band, positives, k):
    rows = edge_rows(anchor_block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = negatives.hard_negatives(df, "label", F.col("vec_id") % 10 == 0, positives, k, anchor_block=anchor_block, row_band=row_band)
    assert multiset(got, *OUT) == brute(rows, 10, positives, k)


def test_huge_components_neither_crash_nor_lose_rows(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0.2, 0.4) for _ in range(6)], i % 2) for i in range(50)]
    rows += [(60, [1e17] * 6, 0), (61, [1e300] * 6, 1), (70, [-1e17, 1e9, 0.0, 0.0, 0.0, 1.0], 0), (71, [3e7] * 6, 0), (72, [2e7] * 6, 1), (73, [1.7e308] * 6, 1)]
    rows = [(*r, "s", "b", 1, "x") for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    scale = [(i, [min(x, 1.7e308 / 256) for x in v], *r) for i, v, *r in rows]  # 256 times the largest is held at the largest double
    got = {r[:4]: r[4:] for r in multiset(negatives.hard_negatives(df, "label", F.col("vec_id") % 10 == 0), *OUT)}
    assert got == {r[:4]: r[4:] for r in brute(scale, 10)}
    assert len(got) > 50


def test_small_and_empty_tables(spark):
    make = lambda rows: spark.createDataFrame([(*r, "s", "b", 1, "x") for r in rows], SCHEMA)
    run = lambda rows: multiset(negatives.hard_negatives(make(rows), "label", F.col("vec_id") % 100 == 0), *OUT)
    assert run([]) == []
    assert run([(0, [1.0], 1)]) == []
    assert run([(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert run([(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]) == [(0, 1, 1, 2, 65536, 32768)]
    # A score of zero has one window, of zero alone; a positive below zero has none.
    assert run([(0, [1.0], 1), (1, [0.0], 1), (2, [0.0], 2), (3, [-1.0], 1), (4, [-0.5], 2)]) == [(0, 1, 1, 2, 0, 0)]


def test_slots_keep_k_each_and_windows_share_them(spark):
    """300 rows under the lowest limit, ties at a limit: every window gets its own first ten, however many others fill."""
    rows = [(0, [1.0], 0), (1, [1.0], 0), (2, [0.5], 0), (3, [0.25], 0)]
    rows += [(10 + i, [0.2], 1) for i in range(300)] + [(400 + i, [0.45], 1) for i in range(30)] + [(500 + i, [0.9], 1) for i in range(4)]
    rows = [(*r, "s", "b", 1, "x") for r in rows]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = negatives.hard_negatives(df, "label", F.col("vec_id") == 0, row_band=50).cache()
    assert multiset(got, *OUT) == brute(rows, 1000)
    assert got.groupBy("positive_id", "slot").count().count() >= 4
    got.unpersist()


def test_scores_are_exact_where_doubles_are_not():
    a = np.array([[2.0 ** 40 + 1, 3.0], [1.0, 2.0]])
    b = np.array([[2.0 ** 20 + 1, 5.0], [7.0, 1.0]])
    want = [[int(sum(int(x) * int(y) for x, y in zip(r, s))) for s in b] for r in a]
    assert negatives.exact_scores(a, b).tolist() == want
    assert negatives.exact_scores(np.array([[2.0 ** 70]]), np.array([[1.0], [-1.0]])).tolist() == [[LONG - 1, -LONG]]
