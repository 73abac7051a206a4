"""run_pipeline end to end over landed gzip JSON files."""

from hitloom.operators import snapshots
from hitloom.plans.pipeline import run_pipeline, stage_for

SF = "/root/testdata/sf0.001"


def test_run_pipeline_all_stages(spark, tmp_path):
    landing = stage_for(spark, SF).landing
    out = str(tmp_path / "wh")
    res = run_pipeline(spark, landing, out, as_of="2024-02-20", keep_raw=True, report_tables=True)
    sessions = spark.read.parquet(f"{SF}/events.parquet").selectExpr(
        "user_id", "unix_micros(cast(ts AS timestamp)) div 21600000000").distinct().count()
    assert res.upsert.first_load and res.upsert.inserted == sessions
    assert spark.read.parquet(f"{out}/raw").count() == sessions
    assert snapshots.read(spark, res.exploded_path).count() > sessions
    assert spark.read.parquet(f"{out}/reports/bounce_rate_per_source").count() == \
        res.reports["bounce_rate_per_source"].count()
    again = run_pipeline(spark, landing, out, as_of="2024-02-20", exploded=False)
    assert again.upsert.inserted == 0
    assert spark.table("conversion_path_for_user").count() == 5


def test_incremental_exploded_refresh_equals_full_refresh(spark, tmp_path):
    from pyspark.sql import functions as F

    from hitloom.operators.explode import explode_sessions
    from hitloom.operators.upsert import upsert
    from hitloom.plans.pipeline import load_compact_batch, refresh_exploded

    landing = stage_for(spark, SF).landing
    batch = load_compact_batch(spark, landing)
    compact, exploded = str(tmp_path / "c"), str(tmp_path / "e")
    early = batch.filter(F.dayofmonth("date") <= 10)
    upsert(early, compact)
    refresh_exploded(spark, compact, exploded)       # first: full
    r2 = upsert(batch, compact)                                          # adds days 11..30
    assert r2.touched and len(r2.touched) >= 20
    assert all(d.day > 10 for d in r2.touched)
    refresh_exploded(spark, compact, exploded)
    r3 = upsert(batch, compact)
    assert r3.inserted == 0 and r3.touched == []
    refresh_exploded(spark, compact, exploded)        # nothing to do
    got = snapshots.read(spark, exploded)
    want = explode_sessions(snapshots.read(spark, compact))
    key = ["fullVisitorId", "visitId", "hits_hitNumber"]
    assert got.count() == want.count()
    assert got.groupBy(*key).count().exceptAll(want.groupBy(*key).count()).count() == 0


def test_other_options_or_other_code_mean_a_full_refresh(spark, tmp_path, monkeypatch):
    from hitloom.operators.explode import explode_sessions
    from hitloom.plans import pipeline

    compact, exploded = stage_for(spark, SF).compact, str(tmp_path / "e")
    refresh = lambda **how: pipeline.refresh_exploded(spark, compact, exploded, **how)
    assert refresh() is None and refresh() == []
    plain = snapshots.read(spark, exploded).count()
    assert refresh(outer_promotions=True) is None
    wide = snapshots.read(spark, exploded).count()
    assert wide == explode_sessions(snapshots.read(spark, compact), outer_promotions=True).count() > plain
    assert refresh(outer_promotions=True) == []
    monkeypatch.setattr(pipeline, "build_signature", lambda *a, **k: "newer code")
    assert refresh(outer_promotions=True) is None


def test_a_session_with_a_third_of_all_hits_multiplies_in_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from hitloom.operators.compact import to_compact
    from hitloom.operators.explode import explode_sessions
    from hitloom.operators.upsert import upsert
    from tests.conftest import docs, session

    hit = lambda i: {"hitNumber": str(i), "promotion": [{"promoName": "a"}, {"promoName": "b"}], "product": [{"productSKU": str(j)} for j in range(i % 4)]}
    hot = session(visitor="1", totals={"visits": "1", "hits": "1000"}, hits=[hit(i) for i in range(1000)])
    others = [session(visitor=str(2 + i), totals={"visits": "1", "hits": "20"}, hits=[hit(j) for j in range(20)]) for i in range(100)]
    upsert(to_compact(docs(spark, hot, *others)), str(tmp_path / "c"))
    compact = snapshots.read(spark, str(tmp_path / "c"))
    dealt, plain = explode_sessions(compact, heavy_hits=1000), explode_sessions(compact)
    key = ["fullVisitorId", "hits_hitNumber", "hits_promotion_promoName", "hits_product_productSKU"]
    rows = lambda df: sorted((tuple(r) for r in df.groupBy(*key).count().collect()), key=repr)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)
    tasks = lambda df: [r["count"] for r in df.where("fullVisitorId = 1").groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks(plain)) == 1
    spread = tasks(dealt)
    assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(spread) < 2 * sum(spread) / len(spread)


def test_rejected_documents_go_to_a_table_with_their_file(spark, tmp_path):
    import json

    from tests.conftest import session
    good, more = [session(visitor=str(i)) for i in range(3)], session(visitor="9", date="20240102")
    no_visitor = {k: v for k, v in session().items() if k != "fullVisitorId"}
    neither = {k: v for k, v in no_visitor.items() if k != "visitId"}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(d) for d in [*good, no_visitor, session(date="2024-01")]) + "\n")
    (tmp_path / "in" / "b.json").write_text(json.dumps(more) + '\n{"fullVisitorId": "7", "visi\n' + json.dumps(neither) + "\n"
                                            + json.dumps(session(visitor="8", visit="x")) + "\n")
    res = run_pipeline(spark, str(tmp_path / "in"), str(tmp_path / "out"), as_of="2024-03-01", exploded=False, rejected="table", view_prefix="rejecting_")
    bad = sorted((r.source_file.rsplit("/", 1)[-1], r.reason) for r in spark.read.parquet(res.rejected_path).collect())
    assert bad == [("a.json", "no fullVisitorId"), ("a.json", "unreadable date"), ("b.json", "malformed document"),
                   ("b.json", "no fullVisitorId, no visitId"), ("b.json", "no visitId")]
    assert res.upsert.inserted == 4 and res.upsert.inserted + len(bad) == 9


def test_two_runs_at_a_time_give_the_result_of_two_in_a_row(spark, tmp_path):
    import threading

    landing, out, errors = stage_for(spark, SF).landing, str(tmp_path / "wh"), []

    def run():
        try:
            run_pipeline(spark, landing, out, as_of="2024-02-20", view_prefix="beside_")
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    once = snapshots.read(spark, stage_for(spark, SF, exploded=True).compact)
    assert snapshots.read(spark, f"{out}/compact").count() == once.count()
    assert snapshots.read(spark, f"{out}/exploded").count() == snapshots.read(spark, stage_for(spark, SF, exploded=True).exploded).count()


def test_hit_level_views_read_the_hit_table(spark, tmp_path):
    landing = stage_for(spark, SF).landing
    res = run_pipeline(spark, landing, str(tmp_path / "wh"), as_of="2024-02-20", exploded=False, hit_table=True)
    plain = run_pipeline(spark, landing, str(tmp_path / "wh"), as_of="2024-02-20", exploded=False)
    for name in ("conversion_path", "promotion_ctr", "unique_page_views"):
        assert "variant" not in res.reports[name]._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, res.reports[name].collect()), key=repr) == sorted(map(tuple, plain.reports[name].collect()), key=repr)


def test_reports_keep_their_order_and_default_date(spark):
    from hitloom.plans import reports
    compact = snapshots.read(spark, stage_for(spark, SF).compact)
    spread = compact.selectExpr("* EXCEPT (date)", "add_months(date, cast(fullVisitorId AS int) % 9) AS date")
    quarters = [(r.year, r.quarter) for r in reports.metrics_per_quarter(spread, "2025-06-01").collect()]
    assert len(quarters) >= 3 and quarters == sorted(quarters, reverse=True)
    by_country = [r.asDict() for r in reports.country_sessions(compact, "2025-01-01").collect()]
    assert [r["country"] for r in by_country] == sorted(r["country"] for r in by_country)
    assert by_country == [r.asDict() for r in reports.country_sessions(compact).collect()]  # by now every day is old enough
