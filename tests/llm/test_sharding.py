import hashlib
import math
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hitloom.llm import sharding

from .conftest import as_sorted, multiset


def test_edge_documents(edge_docs, edge_rows):
    rows = sharding.shard_documents(edge_docs).collect()
    raw = [(r[0], (r[1] or "").encode()) for r in edge_rows]
    assert as_sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == as_sorted((d, len(b) + 1, zlib.crc32(b)) for d, b in raw)
    slots, shard_of = defaultdict(list), {}
    for r in rows:
        assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16) and r.law == "key"
        assert shard_of.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weights_share_the_keys_and_growth_takes_only_into_the_new_shard(spark):
    ids = spark.range(30_000).withColumnRenamed("id", "k")
    weights = [1.0, 2.0, 0.0, 1.0]
    got = ids.select("k", sharding.rendezvous(F.col("k"), weights).alias("a"), sharding.rendezvous(F.col("k"), [*weights, 4.0]).alias("b"),
                     sharding.rendezvous(F.col("k"), [1.0, 2.0, 0.0, 0.0]).alias("c")).collect()
    n = Counter(r.a for r in got)
    assert set(n) == {0, 1, 3} and abs(n[1] / 30_000 - 0.5) < 0.02 and abs(n[0] / 30_000 - 0.25) < 0.02
    assert all(r.b in (r.a, 4) for r in got) and abs(sum(r.b == 4 for r in got) / 30_000 - 0.5) < 0.02
    assert all(r.c == r.a for r in got if r.a != 3)


def test_placement_needs_no_python_and_slots_no_single_task(edge_docs):
    plan = sharding.shard_documents(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan


def test_repeatable_and_empty(edge_docs, no_docs):
    assert multiset(sharding.shard_documents(edge_docs), "doc_id", "size", "slot") == multiset(
        sharding.shard_documents(edge_docs.repartition(5)), "doc_id", "size", "slot")
    assert sharding.shard_documents(no_docs).count() == 0


def independent_shard(doc_id, shards):
    """The shard by its definition: the largest of -weight / ln(u), u from 52 bits of an MD5."""
    def score(i):
        u = (int(hashlib.md5(f"{doc_id}@{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        return -1.0 / math.log(u)

    return max(range(shards), key=lambda i: (score(i), -i))


def test_shards_against_an_independent_version(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 - 1000).alias("doc_id"), F.lit("x").alias("text"))
    for r in sharding.shard_documents(rows).collect():
        assert r.shard == independent_shard(r.doc_id, 16) and r.grown_shard == independent_shard(r.doc_id, 17)


def test_copies_of_one_row_are_numbered_in_many_tasks(spark, monkeypatch):
    from hitloom.llm import common
    copies = spark.range(30_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    other = spark.range(60_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = sharding.shard_documents(copies.union(other))
    got = rows.groupBy("shard").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count("*").alias("n"), F.countDistinct("slot").alias("d")).collect()
    assert sum(r.n for r in got) == 90_000 and all((r.lo, r.hi, r.d) == (0, r.n - 1, r.n) for r in got)
    counted, spread = common.counted_rows(copies, piece=1000)
    tasks = [r["count"] for r in spread(counted).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 30_000 and len(tasks) > 3
    assert spread(counted).agg(F.countDistinct("_nth"), F.max("_nth")).first() == (30_000, 29_999)
