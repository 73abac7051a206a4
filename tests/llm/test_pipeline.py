import json
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hitloom.llm import mixing, packing, pii, rules, simhash
from hitloom.llm.common import table
from hitloom.llm.oracle import ORACLE_SQL
from hitloom.llm.queries import QUERIES
from hitloom.sources.tables import TABLES

from .conftest import multiset
from .test_simhash import brute_print, classes

SF = "/root/testdata/sf0.001"


def stages(spark, docs):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def check(docs, frames, padded=0):
    """Each stage against plain Python on its own input."""
    kept, deduped, renamed, mixed, packed = ([r.asDict() for r in f.collect()] for f in frames[1:])
    assert all(f.columns == docs.columns for f in frames[1:5])
    verdicts = Counter(r.doc_id for r in rules.quality_rules(docs).collect() if r.kept)
    assert Counter(r["doc_id"] for r in kept) == verdicts
    found = classes([brute_print(r["text"]) for r in kept], simhash.RADIUS)
    assert len(deduped) == len(set(found))
    ids = {c: [r["doc_id"] for r, d in zip(kept, found) if d == c and r["doc_id"] is not None] for c in set(found)}
    assert Counter(r["doc_id"] for r in deduped) == Counter(min(v) if v else None for v in ids.values())
    names = pii.Pseudonyms()
    assert Counter((r["doc_id"], r["text"]) for r in renamed) == Counter((r["doc_id"], names.replaced(r["text"])[0]) for r in deduped)
    for r in mixed:
        assert r in renamed
    per = Counter()
    for r in mixing.mix(frames[3]).collect():
        per[r.source] += r.taken
    got = Counter()
    for r in mixed:
        got[r["source"]] += len((r["text"] or "").encode().split())
    assert all(got[s] == per[s] for s in per)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = Counter()
    for r in mixed:
        ids, at = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for n in packing.piece_lengths(len(ids)):
            want[r["doc_id"], at, n, zlib.crc32(ids[at:at + n].tobytes())] += 1
            at += n
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    assert sorted(r["sequence_id"] for r in packed) == list(range(len(packed)))


def test_stages_on_the_test_table(spark):
    docs = table(spark, SF, "documents")
    frames = stages(spark, docs)
    check(docs, frames)
    assert multiset(corpus_pipeline.run(spark, SF), "doc_id", "start", "sequence_id") == multiset(frames[-1], "doc_id", "start", "sequence_id")


def test_stages_on_edge_rows_and_none(spark, edge_docs, no_docs):
    check(edge_docs, stages(spark, edge_docs))
    assert [f.count() for f in stages(spark, no_docs)] == [0] * 6


def test_clean_documents_stay(spark):
    docs = table(spark, SF, "documents").join(table(spark, SF, "labels"), "doc_id")
    got = docs.join(rules.quality_rules(table(spark, SF, "documents")), "doc_id").groupBy("quality").agg({"*": "count"}).collect()
    kept = docs.where("quality = 1").join(rules.kept_documents(table(spark, SF, "documents")), "doc_id", "left_semi").count()
    assert kept >= 0.95 * {r.quality: r["count(1)"] for r in got}[1]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    res = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(got.columns)
    text = lambda rows: Counter(json.dumps([v.item() if hasattr(v, "item") else v for v in r], default=str) for r in rows)
    assert text(res.fetchall()) == text(tuple(r) for r in got.select(*columns).collect())


def test_every_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))


def test_the_rest_does_without_this_part():
    """The entry module still works where this part is not there."""
    root = Path(corpus_pipeline.__file__).parent
    code = ("import sys; sys.path.insert(0, %r); sys.modules['corpus_pipeline'] = None; sys.modules['hitloom.llm'] = None; "
            "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q); e.oracle_sql()" % str(root))
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
