import hashlib
import re

import pytest

from pyspark.sql import functions as F

from hitloom import fs
from hitloom.llm import exact_dedup
from hitloom.llm.exact_dedup import DigestIndex

from .conftest import as_sorted, multiset

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows, seen=None):
    """Decisions over one batch of (doc_id, text); ``seen`` maps digests to the document that stands for them."""
    seen = {} if seen is None else seen
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    groups = {}
    for doc, text in rows:
        groups.setdefault(digest(text), []).append(doc)
    out = []
    for d, docs in groups.items():
        best = max(docs, key=lambda x: (x is not None, x or 0))
        fresh = d not in seen
        keep, done = seen.setdefault(d, best), False
        for doc in docs:
            stays = fresh and doc == best and not done
            done |= stays
            out.append((doc, keep, len(docs), stays, d))
    return as_sorted(out)


def test_one_batch_against_brute_force(spark, edge_docs, edge_rows, tmp_path):
    rows = [(r[0], r[1]) for r in edge_rows]
    got = exact_dedup.deduplicate(DigestIndex.open(spark, str(tmp_path), 4), edge_docs, "a")
    assert multiset(got, *COLUMNS) == brute(rows)


def test_batches_compaction_and_reopening(spark, tmp_path):
    seen, index = {}, DigestIndex.open(spark, str(tmp_path), 4)
    for b in range(4):
        rows = [(b * 100 + i, f"text {i % (7 * (b + 1))}") for i in range(60)] + [(None, None), (None, "")]
        got = exact_dedup.deduplicate(index, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), f"batch-{b}")
        assert multiset(got, *COLUMNS) == brute(rows, seen)
        if b == 1:
            index = index.compact()
            files = fs.list_files(spark, str(tmp_path), ".parquet")
            buckets = [re.search(r"_(\d{5})\.", f).group(1) for f in files]
            assert len(buckets) == len(set(buckets))  # one file a bucket
        if b == 2:  # another session knows the path alone
            spark.sql(f"DROP TABLE {index.name}")
            index = DigestIndex.open(spark, str(tmp_path))
    assert index.buckets == 4 and index.rows().count() == len(seen)
    assert {r.digest.hex(): r.keep_id for r in index.rows().collect()} == seen


def test_a_batch_given_again_gives_the_same_answer(spark, tmp_path):
    index = DigestIndex.open(spark, str(tmp_path), 3)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    second = spark.createDataFrame([(9, "a"), (10, "c"), (11, "c")], "doc_id long, text string")
    exact_dedup.deduplicate(index, first, "one")
    once = multiset(exact_dedup.deduplicate(index, second, "two"), *COLUMNS)
    assert multiset(exact_dedup.deduplicate(index, second, "two"), *COLUMNS) == once
    assert [(r[0], r[1], r[3]) for r in once] == [(10, 11, False), (11, 11, True), (9, 2, False)]
    assert index.rows().count() == 3
    # Under a new name everything has been seen.
    assert not any(r[3] for r in multiset(exact_dedup.deduplicate(index, second, "three"), *COLUMNS))


def test_whole_rows_that_stay(spark, tmp_path):
    rows = [(1, "a", {"k": 1}, None), (1, "a", {"k": 1}, None), (1, "a", {"k": 2}, None), (None, None, None, "r"), (None, "", None, "r"), (5, "b", {}, "key")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, key string")
    index = DigestIndex.open(spark, str(tmp_path), 2)
    kept = exact_dedup.new_documents(index, docs, "x")
    assert kept.columns == docs.columns and kept.count() == 3
    assert sorted((r.text or "") for r in kept.collect()) == ["", "a", "b"]
    assert exact_dedup.new_documents(index, docs, "y").count() == 0


def test_empty_table(spark, no_docs, tmp_path):
    index = DigestIndex.open(spark, str(tmp_path))
    assert exact_dedup.deduplicate(index, no_docs, "x").count() == 0 and index.rows().count() == 0


def test_the_index_is_neither_shuffled_nor_sorted(spark, tmp_path):
    index = DigestIndex.open(spark, str(tmp_path), 4)
    docs = spark.range(2000).select("id", F.col("id").cast("string").alias("text")).withColumnRenamed("id", "doc_id")
    exact_dedup.deduplicate(index, docs, "a")
    index = index.compact()
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    try:
        new = docs.select(exact_dedup.digest_of("text").alias("digest"))
        plan = index.dealt(new).join(index.rows().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize("expected,buckets", [(0, 16), (16_000_000, 16), (16_000_001, 32), (10 ** 10, 16384)])
def test_buckets_follow_the_expected_size(spark, tmp_path, expected, buckets):
    assert DigestIndex.open(spark, str(tmp_path), expected=expected).buckets == buckets


def test_a_text_in_a_third_of_all_rows(spark, tmp_path):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.deduplicate(DigestIndex.open(spark, str(tmp_path), 4), docs, "x")
    assert got.count() == 30_000 and got.where("kept").count() == 20_001
    assert got.where("group_size = 10000 AND keep_id = 29997").count() == 10_000
