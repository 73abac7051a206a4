import re

from hypothesis import given, settings
from hypothesis import strategies as st

from hitloom.llm import licenses
from hitloom.llm.license_rules import parsed

from .conftest import as_sorted, multiset

RULES = parsed()


def brute(text):
    """Words, base places and kept detections, by Python's re and all pairs of intervals."""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    line, starts, at = " " + " ".join(words) + " ", {}, 1
    for i, w in enumerate(words):
        starts[at] = i
        at += len(w) + 1
    base = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    spans = [(starts[m.start()], starts[m.start()] + len(m[0].split()), p, r, label)
             for r, (label, p, _, pattern) in enumerate(RULES) for m in re.finditer(rf"(?<= )(?:{pattern})(?= )", line)]
    kept = [s for s in spans if not any(o[0] <= s[0] and o[1] >= s[1] and (
        o[2] <= s[2] if (o[0], o[1]) != (s[0], s[1]) else (o[2], o[3]) < (s[2], s[3])) for o in spans if o is not s)]
    names = sorted({b[1] for b in base})
    score = max((licenses.CONFIDENCE[s[2]] for s in kept), default=0.0)
    return (len(words), len(base), min((b[0] for b in base), default=None), max((b[0] for b in base), default=None), ",".join(names),
            ",".join(sorted(set(names) | {s[4] for s in kept})), score), sorted((s[4], s[2], s[0], s[1]) for s in kept)


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def test_there_are_hundreds_of_rules_and_every_keyword_has_a_stem():
    assert len(RULES) >= 200 and all(p in licenses.CONFIDENCE for _, p, _, _ in RULES)
    assert [k for _, _, k, _ in RULES if not any(s in k for s in licenses.STEMS)] == []


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_every_match_holds_its_keyword(data):
    label, _, keyword, pattern = data.draw(st.sampled_from(RULES))
    found = data.draw(st.from_regex(re.compile(pattern, re.ASCII), fullmatch=True))
    assert keyword in found, (label, keyword, found)


def test_edge_documents_against_brute_force(edge_docs, edge_rows):
    got = multiset(licenses.scan_licenses(edge_docs), "doc_id", *COLUMNS)
    assert got == as_sorted((r[0], *brute(r[1])[0]) for r in edge_rows)


def test_overlaps_against_brute_force(spark):
    texts = ["Licensed under the Apache License, Version 2.0. See http://www.apache.org/licenses/LICENSE-2.0 apache license",
             "GNU Lesser General Public License, version 2.1 or GNU General Public License v3; SPDX-License-Identifier: GPL-2.0-or-later",
             "MIT License MIT License mit license mit  licence", "Licensed under CC BY-NC-SA 4.0, not CC BY 4.0", "All rights reserved. In the public domain.",
             "either version 3 of the License, or (at your option) any later version of the GNU GPL", "x" * 500, "mit licensé", "MIT License the MIT-License",
             "neither the name of the a b c nor the names of its contributors " * 3, "apache license " * 2000, "Software under 3-clause BSD license or BSD 3-Clause License"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs).collect():
        want, spans = brute(texts[r.doc_id]) if r.doc_id != 10 else ((4000, 2000, 0, 3998, "apache", "apache", 0.6), None)
        assert tuple(r[c] for c in COLUMNS) == want, texts[r.doc_id]
        if spans is not None:
            assert sorted((d.label, d.priority, d.start, d.stop) for d in r.detections) == spans


def test_no_python_and_empty(edge_docs, no_docs):
    plan = licenses.scan_licenses(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "HashAggregate" not in plan and "Window" not in plan
    assert licenses.scan_licenses(no_docs).count() == 0


def test_everyday_spellings(spark):
    want = {"GPL v2": "gpl-2.0", "GPL version 3": "gpl-3.0", "GNU GPL v3": "gpl-3.0", "LGPL v2.1": "lgpl-2.1", "LGPL version 3": "lgpl-3.0", "AGPL v3": "agpl-3.0",
            "GPL v2 or later": "gpl-2.0-or-later", "GPL version 3 or (at your option) any later version": "gpl-3.0-or-later",
            "licensed under the GPL": "gpl", "under the terms of the GNU GPL": "gpl", "licensed under the GPL, version 2": "gpl-2.0", "under GPL-3.0": "gpl-3.0",
            "licensed under MIT": "mit", "released under the MIT": "mit", "Apache-2.0": "apache", "Apache 2.0": "apache", "Apache v2": "apache",
            "licensed under the MIT No Attribution license": "mit-0", "the MIT campus": "", "under the mitre": "", "apache 2": "", "glgpl v2": ""}
    docs = spark.createDataFrame([(f"see {t}, please",) for t in want], "text string")
    got = {r.text: r.labels for r in licenses.scan_licenses(docs, keep=("text",)).collect()}
    assert got == {f"see {t}, please": labels for t, labels in want.items()}


def test_what_only_looks_like_a_license_gets_no_label_or_the_least_score(spark):
    none = ["Server: Apache/2.0.52", "Apache version 2.4 web server", "Apache/2.0 server", "Apache v2 httpd", "the GPL 1 page", "GPL 2 items", "see LGPL 3 there"]
    least = ["released under MIT supervision", "available under the MIT faculty page", "published under the MIT imprint"]
    docs = spark.createDataFrame([(t,) for t in none + least], "text string")
    got = {r.text: (r.labels, r.score) for r in licenses.scan_licenses(docs, keep=("text",)).collect()}
    assert got == {t: ("", 0.0) for t in none} | {t: ("mit", min(licenses.CONFIDENCE.values())) for t in least}
