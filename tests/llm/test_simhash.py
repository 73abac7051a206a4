import random
import re

import numpy as np
import pytest
import xxhash

from hitloom.llm import simhash
from hitloom.llm.components import connected_components

from .conftest import SCHEMA, as_sorted, multiset


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, radius):
    """Union-find over all pairs: index -> smallest index reachable."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("segments,tile_rows", [(8, 16_384), (4, 1)])
def test_edge_documents_against_brute_force(edge_docs, edge_rows, segments, tile_rows):
    prints = [brute_print(r[1]) for r in edge_rows]
    found = classes(prints, 2)
    ids = {c: min((r[0] for r, d in zip(edge_rows, found) if d == c and r[0] is not None), default=None) for c in set(found)}
    want = as_sorted((r[0], f"{p:016x}", ids[c]) for r, p, c in zip(edge_rows, prints, found))
    got = simhash.near_duplicates(edge_docs, segments=segments, tile_rows=tile_rows)
    assert multiset(got, "doc_id", "fingerprint", "component_id") == want


def test_every_close_pair_is_linked_whatever_the_tiles(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = list({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for s in seeds for _ in range(12)} | {0, 1, 2 ** 64 - 1, 2 ** 63})
    signed = [p - 2 ** 64 if p >= 2 ** 63 else p for p in prints]
    place = {p: i for i, p in enumerate(signed)}
    want = classes(prints, 2)
    nodes = spark.createDataFrame([(p,) for p in signed], "fp long")
    for segments, tile_rows in ((8, 5), (4, 16), (2, 3), (1, 16_384)):
        root = list(range(len(prints)))
        for a, b in simhash.linked_pairs(nodes, segments=segments, tile_rows=tile_rows).collect():
            assert (prints[place[a]] ^ prints[place[b]]).bit_count() <= 2 or want[place[a]] == want[place[b]]
            x, y = place[a], place[b]
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        assert [find(i) for i in range(len(prints))] == want


def test_links_of_a_block_span_it_without_all_pairs():
    held = np.arange(64, dtype=np.uint64)
    links = simhash._links(held, held, 6)
    assert sum(len(a) for a, _ in links) < 64


def test_one_document_of_each_group_stays(edge_docs, edge_rows):
    got = simhash.drop_near_duplicates(edge_docs)
    assert got.columns == edge_docs.columns
    kept = multiset(got, "doc_id")
    prints = [brute_print(r[1]) for r in edge_rows]
    found = classes(prints, 2)
    assert len(kept) == len(set(found))
    assert (8,) in kept and (9,) not in kept and (1,) in kept and (2,) not in kept


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).columns == no_docs.columns


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(200, 200), (300, 301), (301, 300)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 150)}, 300: 300, 301: 300}


def test_rows_keep_their_number(spark):
    docs = spark.createDataFrame([(1, "a b c d") + ("en", "s", 1) + ("",) * 9] * 5, SCHEMA)
    assert simhash.near_duplicates(docs).count() == 5
    assert simhash.drop_near_duplicates(docs).count() == 1
