from __future__ import annotations

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, key string, kept string, size string, fp string, part string, block string, copies string, n_words string")


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 9)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, blanks, repeats, ties, near copies, one very long text, a hot source; columns whose names clash."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = prose(400)
    rows = [_row(1, None), _row(2, ""), _row(3, " \t\n\x0b\x0c\r"), _row(4, "one"), _row(5, "Two WORDS"), _row(None, prose(50)), _row(None, None, None, None),
            _row(6, prose(30), None, "b"), _row(7, prose(30), "en", None), _row(8, base), _row(9, base), _row(9, base), _row(10, base + " end"),
            _row(11, base.upper()), _row(12, "Same line here\n" * 9 + "x\n\n  \nlast"), _row(13, "a b c d e " * 12), _row(14, "#### $$$$ a | b " * 40),
            _row(15, prose(60_000)), _row(16, "This is under the MIT License. mit  license! Apache-License, Version 2.0"),
            _row(17, "GNU General Public License, version 2 or later; général public licence"), _row(18, "é" * 3000)]
    rows += [_row(100 + i, prose(rng.randint(12, 90)), rng.choice(["en", "de"]), rng.choice("aaaaabc")) for i in range(120)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(df, *columns):
    key = lambda t: tuple((v is None, str(v)) for v in t)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


def as_sorted(rows):
    return sorted(rows, key=lambda t: tuple((v is None, str(v)) for v in t))
