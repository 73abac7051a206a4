import random
import re
from collections import Counter

import pytest

from hitloom.llm import mixing
from hitloom.llm.common import whole_rows

from .conftest import multiset


def filled(sizes, share=1.5, most=2, weights=(3, 1, 2)):
    """Targets by repeated resharing of what capped sources leave."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = set()
    while len(capped) < len(names):
        level = (share * sum(sizes.values()) - sum(most * sizes[s] for s in capped)) / sum(w[s] for s in names if s not in capped)
        new = {s for s in names if s not in capped and level * w[s] >= most * sizes[s]}
        if not new:
            break
        capped |= new
    return {s: most * sizes[s] if s in capped else level * w[s] for s in names}


@pytest.mark.parametrize("block", [2048, 16])
def test_edge_documents(edge_docs, edge_rows, block):
    rows = mixing.mix(edge_docs, block=block).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r[0], size(r[1])) for r in edge_rows)
    per = Counter()
    for r in edge_rows:
        per[r[3]] += size(r[1])
    want, taken = filled(per), Counter()
    for r in rows:
        assert r.source_size == per[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.size * r.copies and r.copies in (0, 1, 2)
        taken[r.source] += r.taken
    # Within half of what the longest document beside the very long one could move.
    for s, t in want.items():
        assert abs(taken[s] - t) <= (45_000 if s == "a" else 60)


def test_reruns_agree(edge_docs):
    first = multiset(mixing.mix(edge_docs, block=16), "doc_id", "size", "taken")
    assert first == multiset(mixing.mix(edge_docs.repartition(7), block=16), "doc_id", "size", "taken")


def test_flight_keeps_words_and_documents():
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 400):
        sizes = [rng.choice([0, 1, 1, 7, rng.randint(2, 5000)]) for _ in range(n)]
        chance = rng.random()
        p = mixing.flight(sizes, [chance] * n, "x")
        assert sum(p) == pytest.approx(chance * n) and sum(a * b for a, b in zip(p, sizes)) == pytest.approx(chance * sum(sizes))
        assert sum(0 < x < 1 for x in p) <= 2
        assert all(x in (0.0, 1.0) for x in mixing.landing(sizes, p))


def test_chances_are_kept_on_average():
    sizes = [5, 9, 2, 14, 3, 8, 6, 11]
    draws = [mixing.flight(sizes, [0.3] * 8, str(i)) for i in range(600)]
    for i in range(8):
        assert sum(d[i] for d in draws) / 600 == pytest.approx(0.3, abs=0.08)


def test_levels_keep_the_total(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randint(1, 60))), "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, target = Counter(), {}
    for r in mixing.mix(docs, block=64).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 60 for s, t in target.items())  # a document


def test_mixed_documents_repeat_as_taken(edge_docs):
    copies = Counter()
    for r in mixing.mix(edge_docs).collect():
        copies[r.doc_id, r.size] += r.copies
    mixed = mixing.mixed_documents(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert abs(mixed.count() - sum(copies.values())) <= 8


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("hot", [2100, 0])
def test_one_very_long_document_beside_a_hot_source(spark, hot):
    """Small sources land alike whether or not another one needs more levels."""
    rng = random.Random(3)
    sizes = [(f"s{s}", rng.randint(50, 900)) for s in range(6) for _ in range(150)] + [(f"s{s}", 9_000) for s in range(6)]
    sizes += [("hot", rng.randint(1, 40)) for _ in range(hot)]
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(sizes)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    assert Counter((r.source, r.size) for r in rows) == Counter(sizes)
    taken, count, target, per = Counter(), Counter(), {}, Counter(s for s, _ in sizes)
    for r in rows:
        taken[r.source] += r.taken
        count[r.source] += r.copies
        target[r.source] = r.target / r.source_size
        assert r.copies in (int(target[r.source]), int(target[r.source]) + 1)
    for s, ratio in target.items():
        assert abs(taken[s] - ratio * sum(n for x, n in sizes if x == s)) <= 3, s
        assert abs(count[s] - ratio * per[s]) <= 12


def test_landing_offsets_a_long_document():
    rng = random.Random(4)
    for long in (900, 5_000, 40_000):
        sizes = [long, *(rng.randint(50, 900) for _ in range(500))]
        p = [0.5, *(float(i % 2) for i in range(500))]
        new = mixing.landing(sizes, p)
        assert all(x in (0.0, 1.0) for x in new)
        assert abs(sum(a * b for a, b in zip(sizes, new)) - sum(a * b for a, b in zip(sizes, p))) <= 3 and abs(sum(new) - sum(p)) <= 12


def test_rows_whose_nulls_differ_are_different_rows(spark):
    rows = [(1, "t w", "x", None, [1], [2, 3], (None, 5)), (1, "t w", None, "x", [1], [2, 3], (None, 5)), (1, "t w", "x", None, [1, 2], [3], (None, 5)),
            (1, "t w", "x", None, [1], [2, 3], (5, None)), (1, "t w", "x", None, [1], [None, 2, 3], (None, 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, a array<int>, b array<int>, c struct<d: int, e: int>")
    assert whole_rows(docs).select("key").distinct().count() == len(rows)
    mixed = mixing.mixed_documents(docs.limit(2), share=2.0)
    assert Counter(r.source for r in mixed.collect()) == {"x": 2, None: 2}


def test_equal_rows_are_dealt_like_others(spark):
    """A third of all rows are one row: no block is larger than others, and the source still meets its target."""
    from pyspark.sql import functions as F

    rows = [(1, "one two three", "a")] * 3000 + [(10 + i, "w " * (1 + i % 40), "a") for i in range(3000)] + [(9000 + i, "x " * (1 + i % 9), "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block=64)
    assert got.count() == 9000
    per = got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("goal")).collect()
    assert all(abs(r.t - r.goal) <= 3 for r in per)
    assert got.where("taken > 2 * size").count() == 0
    numbered = docs.select("doc_id", "source", mixing.words("text").alias("size"), F.xxhash64("doc_id").alias("unit"))
    counted, spread = mixing.counted_rows(numbered)
    blocks = spread(counted).withColumnRenamed("_nth", "nth").where("source = 'a'").groupBy(F.pmod(mixing._dealt(), F.lit(94)).alias("b")).count()
    assert blocks.agg(F.max("count")).first()[0] < 64 * 2
