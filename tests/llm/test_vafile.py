import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from hitloom.llm import vafile

from .conftest import as_sorted, multiset


def brute(rows, every, k=5, scale=256):
    whole = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(scale * x) for x in v]
        whole[i] = min(whole.get(i, w), w)
    out = []
    for q in (i for i in whole if i % every == 0):
        scores = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(whole[q], whole[c])))), c) for c in whole if c != q)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return as_sorted(out)


@pytest.mark.parametrize("row_block,query_block,scale", [(8192, 4096, 256), (40, 3, 256), (16, 2, 100_000), (64, 50, 2 ** 30)])
def test_against_brute_force(spark, row_block, query_block, scale):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(500, None), (501, []), (502, [1.0, None]), (503, [float("nan")] * 12), (504, [float("inf")] + [0.0] * 11), (None, [0.1] * 12),
             (550, [0.5] * 4), (5, rows[5][1]), (5, rows[5][1]), (600, [-2.0] * 12), (700, [0.0] * 12)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, v string, q int").repartition(4)
    got = vafile.exact_top_k(df, F.col("vec_id") % 10 == 0, scale=scale, row_block=row_block, query_block=query_block)
    assert multiset(got, "query_id", "rank", "vec_id", "score") == brute(rows, 10, scale=scale)


def test_few_rows_and_none(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vafile.exact_top_k(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert vafile.exact_top_k(one, F.lit(True)).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (1, [-0.001])], "vec_id long, embedding array<float>")
    assert multiset(vafile.exact_top_k(two, F.col("vec_id") == 0), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, -256)]


@pytest.mark.parametrize("spread,most", [(0.08, 5), (400.0, 60)])
def test_few_rows_stay_candidates(spread, most):
    """Narrow cells are exact; wide ones leave a small share of the rows whose exact vectors must be read."""
    rng = np.random.default_rng(0)
    exact = np.floor(256 * rng.normal(0, spread, (4000, 64)))
    cells, bits = vafile.approximate(exact)
    assert cells.dtype == np.int8 and (bits.max() == 0) == (spread < 1)
    width = np.ldexp(1.0, bits)[:, None]
    assert ((cells * width <= exact) & (exact <= cells * width + width - 1)).all()
    found = list(vafile.candidates(np.arange(4000), cells, bits, np.array([7]), exact[7:8]))
    scores = exact @ exact[7]
    best = sorted((i for i in range(4000) if i != 7), key=lambda i: (-scores[i], i))[:5]
    assert set(best) <= {f[1] for f in found} and len(found) <= most
    assert all(low <= scores[i] <= high for _, i, high, low in found)


def test_huge_components_end_nothing(spark):
    rows = [(i, [float(i % 7), 1.0, -2.0]) for i in range(30)] + [(100, [1e17] * 3), (110, [-1e300, 1e300, 1.0]), (120, [1.7e308, 0.0, 0.0]), (130, [3e7, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    held = [(i, [max(min(x, 1.7976931348623157e308 / 256), -1.7976931348623157e308 / 256) for x in v]) for i, v in rows]
    got = vafile.exact_top_k(df, F.col("vec_id") % 10 == 0)
    assert multiset(got, "query_id", "rank", "vec_id", "score") == brute(held, 10)


def test_many_equal_vectors_leave_k_candidates_a_block():
    same = np.full((5000, 8), 3.0)
    cells, bits = vafile.approximate(same)
    found = list(vafile.candidates(np.arange(5000), cells, bits, np.array([0]), same[:1]))
    assert [f[1] for f in found] == [1, 2, 3, 4, 5]
