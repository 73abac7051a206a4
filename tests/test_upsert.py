import sys

import pytest
from pyspark.sql import functions as F

from hitloom.operators import snapshots
from hitloom.operators.compact import to_compact
from hitloom.operators.upsert import upsert
from tests.conftest import docs, session

E1 = session(visitor="1", totals={"visits": "1", "hits": "3"})
E3 = session(visitor="1", totals={"visits": "1", "hits": "4"})     # same visit, changed
OTHER = session(visitor="2", date="20240102", visit="19724")


def _c(spark, *ds):
    return to_compact(docs(spark, *ds))


def test_first_load_creates_and_rerun_is_idempotent(spark, tmp_table):
    r1 = upsert(_c(spark, E1, OTHER), tmp_table)
    r2 = upsert(_c(spark, E1, OTHER), tmp_table)
    assert (r1.first_load, r1.inserted) == (True, 2)
    assert (r2.first_load, r2.inserted) == (False, 0)
    t = snapshots.read(spark, tmp_table)
    assert t.count() == 2
    assert sorted(snapshots.state(spark, tmp_table).parts) == ["date=2024-01-01", "date=2024-01-02"]


def test_e3_changed_document_is_inserted_beside_by_default(spark, tmp_table):
    upsert(_c(spark, E1), tmp_table)
    upsert(_c(spark, E3), tmp_table)
    assert snapshots.read(spark, tmp_table).count() == 2


def test_e3_two_column_keys_replace_on_change(spark, tmp_table):
    keys = ("fullVisitorId", "visitId")
    upsert(_c(spark, E1, OTHER), tmp_table, keys=keys)
    r = upsert(_c(spark, E3), tmp_table, keys=keys)
    t = snapshots.read(spark, tmp_table)
    assert t.count() == 2 and r.inserted == 0
    assert t.filter(F.col("fullVisitorId") == "1").collect()[0].totals_hits == 4


def test_replace_moves_row_to_new_date_and_clears_empty_partition(spark, tmp_table):
    keys = ("fullVisitorId", "visitId")
    upsert(_c(spark, E1, OTHER), tmp_table, keys=keys)
    moved = session(visitor="1", date="20240105")
    upsert(_c(spark, moved), tmp_table, keys=keys)
    t = snapshots.read(spark, tmp_table)
    assert t.count() == 2
    assert t.filter(F.col("fullVisitorId") == "1").collect()[0].date.isoformat() == "2024-01-05"


def test_e4_duplicates_in_one_batch(spark, tmp_table):
    assert upsert(_c(spark, E1, E1), tmp_table).inserted == 1
    assert upsert(_c(spark, E1, E1), tmp_table + "k", duplicates="keep").inserted == 2
    with pytest.raises(ValueError):
        upsert(_c(spark, E1, E1), tmp_table + "e", duplicates="error")


def test_existing_foreign_table_is_adopted_not_overwritten(spark, tmp_table):
    _c(spark, OTHER).write.partitionBy("date").parquet(tmp_table)     # written without upsert
    r = upsert(_c(spark, E1), tmp_table)
    assert not r.first_load and r.inserted == 1
    assert snapshots.read(spark, tmp_table).count() == 2


KEYS = ("fullVisitorId", "visitId")


def test_null_keys_match_nothing(spark, tmp_table):
    rows = spark.createDataFrame([(None, 1, "a"), (None, 1, "b"), (7, 1, "c"), (7, 1, "c")], "k int, p int, v string")
    for n in (3, 5):
        upsert(rows, tmp_table, keys=("k",), partition_by="p", cluster_by="k")
        assert snapshots.read(spark, tmp_table).count() == n


@pytest.mark.parametrize("value", ["x:y", "a b", "k=v", "100%", "a/b"])
def test_rows_leave_partitions_whose_names_are_escaped(spark, tmp_table, value):
    old = spark.createDataFrame([(1, value, 0), (2, "other", 0)], "k int, p string, v int")
    upsert(old, tmp_table, keys=("k",), partition_by="p", cluster_by="k")
    upsert(spark.createDataFrame([(1, "new", 1)], "k int, p string, v int"), tmp_table, keys=("k",), partition_by="p", cluster_by="k")
    assert sorted(tuple(r) for r in snapshots.read(spark, tmp_table).select("k", "p", "v").collect()) == [(1, "new", 1), (2, "other", 0)]


def test_many_partitions_are_all_rebuilt(spark, tmp_table):
    rows = spark.range(60).selectExpr("id AS k", "concat('p', id) AS p", "0 AS v")
    upsert(rows, tmp_table, keys=("k",), partition_by="p", cluster_by="k")
    moved = rows.selectExpr("k", "concat('p', k % 7) AS p", "1 AS v")
    upsert(moved, tmp_table, keys=("k",), partition_by="p", cluster_by="k")
    t = snapshots.read(spark, tmp_table)
    assert t.count() == 60 and t.where("v = 1 AND p = concat('p', k % 7)").count() == 60


def test_more_values_than_any_list_was_capped_at(spark):
    from hitloom.operators.upsert import _in, _values
    many = spark.range(30_000).withColumnRenamed("id", "p")
    values = _values(many, "p")
    assert len(values) == 30_000 and many.filter(_in("p", values)).count() == 30_000


@pytest.mark.parametrize("stop", ["write_clustered", "publish"])
def test_a_rewrite_that_stops_changes_nothing_and_can_be_repeated(spark, tmp_table, monkeypatch, stop):
    upsert(_c(spark, E1, OTHER), tmp_table, keys=KEYS)
    moved = _c(spark, session(visitor="1", date="20240105"))

    def fail(*a, **k):
        raise OSError("lost")

    def rows():
        return sorted((r.fullVisitorId, str(r.date)) for r in snapshots.read(spark, tmp_table).collect())

    with monkeypatch.context() as m:
        m.setattr(sys.modules["hitloom.operators.upsert"] if stop == "write_clustered" else snapshots, stop, fail)
        with pytest.raises(OSError):
            upsert(moved, tmp_table, keys=KEYS)
    assert rows() == [("1", "2024-01-01"), ("2", "2024-01-02")]
    upsert(moved, tmp_table, keys=KEYS)
    assert rows() == [("1", "2024-01-05"), ("2", "2024-01-02")]


def test_unpartitioned_table_is_replaced_on_key(spark, tmp_table):
    for v in (0, 1):
        upsert(spark.createDataFrame([(1, v), (2 + v, v)], "k int, v int"), tmp_table, keys=("k",), partition_by=None, cluster_by="k")
    assert sorted(tuple(r) for r in snapshots.read(spark, tmp_table).collect()) == [(1, 1), (2, 0), (3, 1)]


def test_rerun_writes_nothing_and_one_new_document_touches_one_date(spark, tmp_table, monkeypatch):
    module = sys.modules["hitloom.operators.upsert"]
    upsert(_c(spark, E1, OTHER), tmp_table)
    assert upsert(_c(spark, E1, OTHER, session(visitor="3")), tmp_table).touched == [__import__("datetime").date(2024, 1, 1)]
    monkeypatch.setattr(module, "write_clustered", None)
    assert upsert(_c(spark, E1, OTHER), tmp_table).inserted == 0
