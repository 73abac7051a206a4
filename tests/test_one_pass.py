"""Work that grows with the input is done once, and by all cores."""

import datetime
import sys

import pytest
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.operators import snapshots
from hitloom.operators.upsert import upsert
from hitloom.plans.catalog import QUERIES
from hitloom.sources.fixtures import session_docs_for
from hitloom.sources.tables import spread, table


@pytest.fixture()
def tables(spark, tmp_path):
    at = lambda day, hour: datetime.datetime(2024, 1, day, hour, 5)
    rows = [(i, at(1 + i % 3, i % 24), 17 + i % 5, ("view", "purchase", "click", "error")[i % 4], 1.5, '{"k": %d}' % i) for i in range(60)]
    rows += [(90, at(1, 1), None, "view", 1.0, '{"k": 1}'), (91, None, 18, "view", 1.0, '{"k": 1}')]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    nation = spark.createDataFrame([(17, "N", 1), (18, "M", 1)], "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(1, "R")], "r_regionkey int, r_name string")
    for name, df in (("events", events), ("nation", nation), ("region", region)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_table_of_one_file_is_dealt_to_all_cores(spark, tables):
    events = table(spark, tables, "events")
    assert events.rdd.getNumPartitions() == 1
    dealt = spread(events, "event_id")
    assert dealt.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert sorted(r.event_id for r in dealt.collect()) == sorted(r.event_id for r in events.collect())


def test_session_documents_read_the_events_once(spark, tables):
    docs = session_docs_for(spark, tables)
    plan = _plan(docs)
    assert plan.count("ReadSchema: struct<event_id") == 1, plan
    assert {r.user_id for r in docs.collect()} == {17, 18, 19, 20, 21}   # no session without user or time
    hits = F.size(F.variant_get(F.parse_json("doc"), "$.hits", "array<variant>"))
    assert docs.agg(F.sum(hits)).first()[0] == 60


def _batch(spark, met, days, first=0, null=False):
    def seen(v):
        met.add(1)
        return v
    rows = [(str(i), None if null and i % 5 == 0 else i, datetime.date(2024, 1, days[i % len(days)])) for i in range(first, first + 20)]
    df = spark.createDataFrame(rows, "fullVisitorId string, visitId bigint, date date")
    return df.withColumn("hash_id", F.udf(seen, "string")("fullVisitorId"))


def test_a_first_load_extracts_its_batch_once(spark, tmp_table):
    met = spark.sparkContext.accumulator(0)
    assert upsert(_batch(spark, met, [1, 2]), tmp_table).inserted == 20
    assert met.value == 20


def test_later_loads_extract_what_is_new_once_more(spark, tmp_table):
    none = spark.sparkContext.accumulator(0)
    upsert(_batch(spark, none, [1, 2]), tmp_table)
    met = spark.sparkContext.accumulator(0)
    res = upsert(_batch(spark, met, [1, 2, 3], first=10, null=True), tmp_table)   # 10..19 may be known, 20..29 are new
    assert met.value <= 40                                                        # keys, then rows: not rows twice
    again = upsert(_batch(spark, none, [1, 2, 3], first=10, null=True).where("visitId IS NOT NULL"), tmp_table)
    assert again.inserted == 0 and again.touched == []
    rows = [tuple(r) for r in snapshots.read(spark, tmp_table).select("fullVisitorId", "visitId").collect()]
    expect = {(str(i), i) for i in range(20)} | {(str(i), None if i % 5 == 0 else i) for i in range(10, 30)}
    assert set(rows) == expect and len(rows) == 20 + res.inserted


def test_parts_of_a_batch_are_fresh_by_date_or_by_key(spark, tmp_table):
    none = spark.sparkContext.accumulator(0)
    upsert(_batch(spark, none, [1]).where("visitId < 10"), tmp_table)
    batch = _batch(spark, none, [1]).unionByName(_batch(spark, none, [2, 3], first=20))
    res = upsert(batch, tmp_table)
    assert res.inserted == 30 and {str(d) for d in res.touched} == {"2024-01-01", "2024-01-02", "2024-01-03"}
    assert snapshots.read(spark, tmp_table).select("visitId").distinct().count() == 40


@pytest.mark.parametrize("name", ["content_dedupe", "required_key_check"])
def test_documents_that_two_results_need_are_read_once(spark, tables, name):
    df = QUERIES[name](spark, tables)
    assert "struct<event_id" not in _plan(df)
    n = session_docs_for(spark, tables).count()
    if name == "content_dedupe":
        assert [sum(r[c] for r in df.collect()) for c in ("documents", "distinct_hashes", "deduped_rows")] == [2 * n, n, n]
    else:
        assert sum(r.sessions for r in df.collect()) == n


def test_a_first_load_is_written_once_where_it_stays(spark, tmp_table, monkeypatch):
    module = sys.modules["hitloom.operators.upsert"]
    staged, none = [], spark.sparkContext.accumulator(0)
    was = module.stage
    monkeypatch.setattr(module, "stage", lambda df, name="batch", created=None: staged.append(df.columns) or was(df, name, created))
    upsert(_batch(spark, none, [1, 2]), tmp_table)
    assert all("date" not in columns for columns in staged)   # keys that come twice are staged, whole rows are not
    live = {g for gens in snapshots.state(spark, tmp_table).parts.values() for g in gens}
    assert fs.child_names(spark, tmp_table) == [f"gen={g}" for g in live]


@pytest.mark.parametrize("how", [{}, {"duplicates": "keep"}, {"max_records": 4}, {"duplicates": "error"}, {"keys": ("visitId", "date")}])
def test_first_loads_with_copies_and_of_several_files(spark, tmp_table, how):
    none = spark.sparkContext.accumulator(0)
    batch = _batch(spark, none, [1, 2], null=True)
    batch = batch.unionByName(batch.where("visitId < 7 OR visitId IS NULL"))
    if how.get("duplicates") == "error":
        with pytest.raises(ValueError, match="duplicate keys"):
            upsert(batch, tmp_table, **how)
        assert snapshots.state(spark, tmp_table) is None and fs.child_names(spark, tmp_table) == []
        return
    res = upsert(batch, tmp_table, **how)
    copies = 1 if how.get("duplicates") != "keep" else 2
    got = sorted((r.fullVisitorId, r.visitId, str(r.date)) for r in snapshots.read(spark, tmp_table).collect())
    expect = [(str(i), None if i % 5 == 0 else i, f"2024-01-0{1 + i % 2}") for i in range(20)
              for _ in range(2 if i % 5 == 0 else copies if i < 7 else 1)]
    assert got == sorted(expect) and res.inserted == len(expect)
    assert len(fs.child_names(spark, tmp_table)) == 1


@pytest.mark.parametrize("name", ["upsert_idempotent", "upsert_insert_only", "upsert_late_documents", "exploded_after_replace", "views_follow_table",
                                  "report_tables_current"])
def test_queries_extract_their_documents_once_and_build_no_other_table(spark, tables, monkeypatch, name):
    from hitloom.plans import catalog, pipeline
    merged, read = [], []
    was, load = catalog.upsert, catalog.load_compact_batch
    monkeypatch.setattr(catalog, "upsert", lambda new, *a, **how: merged.append("singleVariantColumn" in _plan(new) or "FileScan json" in _plan(new)) or was(new, *a, **how))
    monkeypatch.setattr(catalog, "load_compact_batch", lambda *a: read.append(1) or load(*a))
    catalog.QUERIES[name](spark, tables).collect()
    assert len(read) == 1 and len(merged) >= 2 and not any(merged)
    assert not fs.exists(spark, pipeline.stage_paths(spark, tables).compact)
