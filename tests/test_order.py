from pyspark.sql import functions as F

from hitloom.operators.order import numbered


def test_positions_over_many_partitions(spark):
    df = spark.range(5000).select(F.col("id"), F.pmod(F.xxhash64("id"), F.lit(97)).alias("v")).repartition(7)
    got = sorted(tuple(r) for r in numbered(df, F.desc("v"), F.asc("id")).select("pos", "v", "id").collect())
    want = sorted(((r.v, r.id) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    assert [g[0] for g in got] == list(range(1, 5001)) and [g[1:] for g in got] == want


def test_no_rows(spark):
    assert numbered(spark.range(0), F.asc("id")).count() == 0
