"""Views as text: they answer with what the table holds when they are asked, under the names that were given."""

import pytest
from pyspark.sql import functions as F

from hitloom.operators import snapshots
from hitloom.operators.upsert import upsert
from hitloom.plans import reports, views
from hitloom.plans.hit_reports import refresh_hits
from hitloom.plans.pipeline import stage_for

SF = "/root/testdata/sf0.001"
AS_OF = "2024-02-20"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def stage(spark):
    return stage_for(spark, SF, hits=True)


@pytest.mark.parametrize("options", [{}, {"exact_session_key": True, "distinct_users": True, "title_key": "pageTitle", "days": 25}])
@pytest.mark.parametrize("from_hits", [False, True])
def test_every_view_equals_its_report(spark, stage, options, from_hits):
    names = views.publish_views(spark, stage.compact, AS_OF, prefix="same_", hits_path=stage.hits if from_hits else None, **options)
    compact = snapshots.read(spark, stage.compact)
    for report, fn in reports.REPORTS.items():
        known = {k: v for k, v in options.items() if k in fn.__code__.co_varnames[:fn.__code__.co_argcount]}
        got, want = spark.sql(f"SELECT * FROM {names[report]}"), fn(compact, AS_OF, **known)
        assert got.dtypes == want.dtypes, report
        assert rows(got) == rows(want), report


def test_views_follow_appends_and_replacements(spark, stage, tmp_path):
    table = str(tmp_path / "compact")
    batch = snapshots.read(spark, stage.compact)
    upsert(batch.where(F.dayofmonth("date") <= 5), table)
    names = views.publish_views(spark, table, AS_OF, prefix="follow_")
    total = lambda: spark.sql(f"SELECT sum(total_visits) FROM {names['bounce_rate_per_source']}").first()[0]
    first = total()
    upsert(batch, table)
    assert total() == spark.sql("SELECT 1").count() * reports.bounce_rate_per_source(batch, AS_OF).agg(F.sum("total_visits")).first()[0] > first
    upsert(batch.withColumn("totals_visits", F.lit(None).cast("long")), table, keys=("fullVisitorId", "visitId"))
    assert total() == 0
    for _ in range(snapshots.KEEP + 1):  # until the files the views first saw are gone
        upsert(batch.where(F.dayofmonth("date") <= 5), table, keys=("fullVisitorId", "visitId"))
    assert total() == first


def test_without_a_date_the_cutoff_is_that_of_the_query(spark, stage):
    text = views.report_sql("t")["country_sessions"]
    assert "current_date()" in text
    names = views.publish_views(spark, stage.compact, prefix="today_")
    assert rows(spark.table(names["country_sessions"])) == rows(reports.country_sessions(snapshots.read(spark, stage.compact)))


def test_two_warehouses_in_one_session(spark, stage, tmp_path):
    other = str(tmp_path / "compact")
    upsert(snapshots.read(spark, stage.compact).limit(3), other)
    one = views.publish_views(spark, stage.compact, AS_OF, prefix="one_")
    two = views.publish_views(spark, other, AS_OF, names={"country_sessions": "countries"}, prefix="two_")
    assert two["country_sessions"] == "`two_countries`"
    total = lambda n: spark.sql(f"SELECT sum(total_visits) FROM {n['bounce_rate_per_source']}").first()[0] or 0
    assert total(one) > total(two)
    with pytest.raises(ValueError):
        views.publish_views(spark, other, names={"nothing": "x"})


def test_persistent_views(spark, stage):
    spark.sql("CREATE DATABASE IF NOT EXISTS report_views")
    names = views.publish_views(spark, stage.compact, AS_OF, schema="report_views")
    assert names["country_sessions"] == "`report_views`.`session_bounce_rate_per_country`"
    want = reports.country_sessions(snapshots.read(spark, stage.compact), AS_OF)
    assert rows(spark.sql(f"SELECT * FROM {names['country_sessions']}")) == rows(want)
    spark.sql("DROP DATABASE report_views CASCADE")


def test_the_per_hit_table_follows_too(spark, stage, tmp_path):
    table, hits = str(tmp_path / "compact"), str(tmp_path / "hits")
    batch = snapshots.read(spark, stage.compact)
    upsert(batch.where(F.dayofmonth("date") <= 5), table)
    refresh_hits(spark, table, hits)
    names = views.publish_views(spark, table, AS_OF, prefix="hits_follow_", hits_path=hits)
    upsert(batch, table)
    refresh_hits(spark, table, hits)
    assert rows(spark.table(names["promotion_ctr"])) == rows(reports.promotion_ctr(batch, AS_OF))
