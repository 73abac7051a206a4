"""Reports over the per-hit table equal the compact-based reports."""

import pytest

from hitloom.operators import snapshots
from hitloom.plans import hit_reports, reports
from hitloom.plans.pipeline import stage_for

SF = "/root/testdata/sf0.001"
AS_OF = "2024-02-20"


@pytest.fixture(scope="module")
def tables(spark):
    st = stage_for(spark, SF, hits=True)
    return snapshots.read(spark, st.compact), snapshots.read(spark, st.hits)


@pytest.mark.parametrize("name,kw", [("conversion_path", {}),
                                     ("conversion_path", {"distinct_users": True}),
                                     ("promotion_ctr", {}),
                                     ("unique_page_views", {}),
                                     ("unique_page_views", {"title_key": "pageTitle"})])
def test_hit_table_reports_equal_compact_reports(tables, name, kw):
    compact, hits = tables
    got = hit_reports.HIT_REPORTS[name](hits, AS_OF, **kw)
    want = reports.REPORTS[name](compact, AS_OF, **kw)
    assert got.columns == want.columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_hit_table_is_narrow_and_one_row_per_hit(spark, tables):
    compact, hits = tables
    assert "hits" not in hits.columns and len(hits.columns) <= 13
    total_hits = compact.selectExpr("sum(totals_hits)").collect()[0][0]
    assert hits.count() == total_hits


def test_incremental_hits_refresh_equals_full(spark, tmp_path):
    from pyspark.sql import functions as F
    from hitloom.operators.upsert import upsert
    from hitloom.plans.pipeline import load_compact_batch
    batch = load_compact_batch(spark, stage_for(spark, SF).landing)
    compact, hits = str(tmp_path / "c"), str(tmp_path / "h")
    upsert(batch.filter(F.dayofmonth("date") <= 10), compact)
    hit_reports.refresh_hits(spark, compact, hits)
    upsert(batch, compact)
    hit_reports.refresh_hits(spark, compact, hits)
    got = snapshots.read(spark, hits).drop("promotions")
    want = hit_reports.build_hits(snapshots.read(spark, compact)).drop("promotions")
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_hit_table_reports_scan_only_named_columns(tables):
    import re
    _, hits = tables
    plan = hit_reports.conversion_path(hits, AS_OF)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    cols = {c.split("#")[0] for s in scans for c in s.split(",")}
    assert cols - {"gen"} == {"fullVisitorId", "action", "n_products", "date"}, cols  # gen: a folder name, not read from files
    assert "PartitionFilters: [isnotnull(date" in plan
