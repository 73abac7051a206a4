"""Keys of a small batch are looked up through statistics and Bloom filters: fewer rows are read, results are equal."""
import datetime
import sys

import pytest
from pyspark.sql import functions as F

from hitloom.operators import snapshots
from hitloom.operators.upsert import key_candidates, looking_up, upsert

ROWS, FILE = 120_000, 30_000
HOW = dict(keys=("hash_id",), cluster_by="visitor", max_records=FILE)


def sessions(spark, start, end):
    """Hashes of 64 digits: a file of them outgrows its dictionary, so only a Bloom filter can answer."""
    return spark.range(start, end).select(
        F.format_string("%07d", F.col("id") * 7 % 100_003).alias("visitor"), F.sha2(F.col("id").cast("string"), 256).alias("hash_id"),
        F.col("id").alias("value"), F.lit(datetime.date(2024, 1, 1)).alias("date"))


def rows_read(df):
    """Rows that left the scan of ``df``."""
    spark = df.sparkSession
    with looking_up(spark):
        df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lookup") / "t")
    upsert(sessions(spark, 0, ROWS), path, **HOW)
    return path


@pytest.mark.parametrize("ids,most", [((200_000, 200_001), 0), ((77, 78), FILE)])
def test_one_document_reads_few_rows_of_its_date(spark, loaded, ids, most):
    table, batch = snapshots.read(spark, loaded), sessions(spark, *ids)
    some = key_candidates(table, batch, ["hash_id"], "date").select("hash_id")
    # A filter errs in about 1 % of the files.
    assert rows_read(some) <= most + FILE
    assert some.join(batch, "hash_id").count() == (1 if most else 0)
    assert rows_read(key_candidates(table, batch, ["hash_id"], "date", limit=0).select("hash_id")) == ROWS


def test_the_clustered_key_is_looked_up_by_ranges(spark, loaded):
    table, batch = snapshots.read(spark, loaded), sessions(spark, 77, 78)
    assert rows_read(key_candidates(table, batch, ["visitor", "hash_id"], "date").select("hash_id")) <= FILE


def test_small_batch_gives_what_a_large_one_would(spark, tmp_table, monkeypatch):
    module = sys.modules["hitloom.operators.upsert"]
    paths = {}
    for limit in (500, 0):
        monkeypatch.setattr(module, "key_candidates", lambda *a, limit=limit: key_candidates(*a, limit=limit))
        paths[limit] = path = f"{tmp_table}-{limit}"
        upsert(sessions(spark, 0, 3000), path, **HOW)
        late = sessions(spark, 2950, 3050).unionByName(sessions(spark, 2950, 3000))
        assert upsert(late, path, **HOW).inserted == 50
        moved = sessions(spark, 10, 40).withColumn("date", F.lit(datetime.date(2024, 1, 9))).withColumn("value", F.lit(-1).cast("long"))
        by_visitor = dict(HOW, keys=("visitor", "value"))
        assert upsert(moved, path, **by_visitor).inserted == 30
        assert upsert(moved, path, **dict(HOW, keys=("visitor",))).replaced_partitions == 2
    whole = {n: sorted(map(str, snapshots.read(spark, p).collect())) for n, p in paths.items()}
    assert whole[500] == whole[0]
    assert len(whole[0]) == 3050


@pytest.mark.parametrize("kind,old,new", [("double", "0.0", "-0.0"), ("double", "nan", "nan"), ("float", "1.5", "1.5"), ("int", "7", "7"),
                                          ("tinyint", "-1", "-1"), ("date", "1500-01-01", "1500-01-01"), ("string", "é中", "é中"),
                                          ("string collate UTF8_LCASE", "AB", "ab"), ("string", "a", None)])
def test_keys_of_every_type(spark, tmp_table, kind, old, new):
    make = lambda v: spark.range(1).select(F.lit(v).cast(kind).alias("hash_id"), F.lit(1).alias("p"), F.lit(v).alias("was"))
    how = dict(keys=("hash_id",), partition_by="p", cluster_by="p")
    upsert(make(old), tmp_table, **how)
    assert upsert(make(new), tmp_table, **how).inserted == (new is None)


def test_bytes_that_are_no_text(spark, tmp_table):
    odd = spark.range(1).select(F.expr("cast(X'61FF' AS string)").alias("hash_id"), F.lit(1).alias("p"))
    how = dict(keys=("hash_id",), partition_by="p", cluster_by="p")
    upsert(odd, tmp_table, **how)
    assert upsert(odd, tmp_table, **how).inserted == 0
