import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from hitloom.llm import spelling
from hitloom.llm.queries import op13_spelling_variants
from hitloom.sources.tables import table

from .conftest import as_sorted, multiset

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def counted(rows, least_length=7, least_count=2, thinned=31):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % thinned == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least_count}


def neighbours(words):
    """Pairs at one edit, by the words that are left when one letter is struck out."""
    holes, near = {}, {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + w[i + 1:]), []).append(w)  # replacement: the same letter struck out
            if w[:i] + w[i + 1:] in near:
                near[w].add(w[:i] + w[i + 1:])
                near[w[:i] + w[i + 1:]].add(w)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if a != b)
    return near


def brute(n, times=10):
    near = neighbours(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return as_sorted(out)


@pytest.mark.parametrize("groups,node_words", [(16, 20_000), (16, 50), (4, 10), (3, 7), (26, 1)])
def test_words_against_brute_force(spark, groups, node_words):
    rng = random.Random(groups)
    words = {"".join(rng.choice("abcqé") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7]))) for _ in range(700)}
    words |= {"a" * 300, "a" * 301, "a" * 302, "a" * 300 + "b", "ÿ" * 9, "ab" * 150, "ba" * 150}
    n = {w: rng.choice([1, 2, 5, 30, 400]) for w in sorted(words)}
    near = neighbours(n)
    df = spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)
    got = multiset(spelling.near_words(df, groups, node_words), "word", "near", "near_n")
    assert got == as_sorted([(w, x, n[x]) for w in n for x in near[w]])


def test_documents_against_brute_force(spark, edge_docs, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    for length, count, thinned, times in ((7, 2, 31, 10), (3, 1, 3, 2)):
        got = spelling.spelling_variants(edge_docs, length, count, times, thinned, node_words=60)
        assert multiset(got, *COLUMNS) == brute(counted(rows, length, count, thinned), times)


def test_the_query_over_its_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    got = multiset(op13_spelling_variants(spark, sf_dir), *COLUMNS)
    assert got == brute(counted(rows))
    assert sum(r[1] is not None for r in got) > 5


def test_chains_ties_and_very_long_words(spark):
    long = "x" * 30_000
    texts = ["abcdefgh " * 2000, "abcdefgx " * 150, "abcdefyx " * 10, "bbcdefgh " * 2000, "zbcdefgh " * 3, f"{long} {long} {long}y {long}y"]
    rows = [(None, t) for t in texts] + [(None, None), (None, "")]
    got = spelling.spelling_variants(spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int"), thinned=10 ** 9)
    assert multiset(got, *COLUMNS) == brute(counted(rows, thinned=10 ** 9))
    roots = {r.word: r.root for r in got.collect()}
    assert roots["abcdefyx"] == "abcdefgh" and roots["zbcdefgh"] == "abcdefgh"


def test_empty_table(spark, no_docs):
    assert spelling.spelling_variants(no_docs).count() == 0


def test_roots_of_long_chains(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)], "word string, form string")
    assert all(r.root == "w37" for r in spelling.roots_of(links).collect())


def test_a_hot_node_is_walked_in_one_search_per_block():
    """The search visits a trie, not all pairs: far fewer letters are compared than words x words."""
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(3000)})
    flat, lengths = spelling.letters(words)
    counts = spelling.vectors(flat, lengths)
    order = np.lexsort(counts.T[::-1])
    codes = flat.reshape(len(words), -1)
    seen, real = [], spelling._verified
    spelling._verified = lambda a, b: seen.append(len(a)) or real(a, b)
    try:
        one = np.ones(len(words), int)
        found = {(i, order[j]) for a, b in spelling.search(codes[order], counts[order], codes, counts, one, one, 0) for i, j in zip(a, b)}
    finally:
        spelling._verified = real
    near = neighbours(words)
    assert found == {(i, words.index(x)) for i, w in enumerate(words) for x in near[w]}
    assert sum(seen) < len(words) ** 2 / 50
