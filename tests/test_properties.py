"""Property tests (generated documents)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hitloom.functions.metrics import date_cutoff
from hitloom.operators import snapshots
from hitloom.operators.compact import to_compact
from hitloom.operators.flatten import flatten
from hitloom.operators.upsert import upsert
from hitloom.plans import reports
from tests.conftest import docs, session

ARRAYS = st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=6)


def _doc(i, n_products):
    hits = None if n_products is None else [
        {"product": [{"productSKU": f"{i}-{j}"} for j in range(n_products)]}]
    d = session(visitor=str(i))
    if hits is not None:
        d["hits"] = hits
    return d


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ARRAYS)
def test_flatten_counts_follow_array_lengths(spark, lengths):
    c = to_compact(docs(spark, *[_doc(i, n) for i, n in enumerate(lengths)]))
    hits = flatten(c, "hits", "hit")
    inner = flatten(hits, "hit", "p", path="$.product").count()
    outer = flatten(hits, "hit", "p", path="$.product", outer=True).count()
    present = [n for n in lengths if n is not None]
    assert inner == sum(present)
    assert outer == sum(max(1, n) for n in present)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["1", None]),
                          st.sampled_from(["20240101", "20240125"])), min_size=1, max_size=12))
def test_group_counts_sum_to_filtered_rows(spark, rows):
    ds = []
    for i, (src, visits, date) in enumerate(rows):
        d = session(visitor=str(i), date=date, totals={"visits": visits} if visits else {})
        if src:
            d["trafficSource"] = {"source": src}
        ds.append(d)
    c = to_compact(docs(spark, *ds))
    r = reports.bounce_rate_per_source(c, "2024-02-20")
    total = r.agg(F.sum("total_visits")).collect()[0][0] or 0   # empty report -> 0
    assert total == c.filter(date_cutoff("2024-02-20") & F.col("totals_visits").isNotNull()).count()


def test_upsert_twice_equals_once(spark, tmp_path):
    ds = [session(visitor=str(i), date=f"202401{i % 9 + 1:02d}") for i in range(20)]
    upsert(to_compact(docs(spark, *ds)), str(tmp_path / "once"))
    upsert(to_compact(docs(spark, *ds)), str(tmp_path / "twice"))
    upsert(to_compact(docs(spark, *ds)), str(tmp_path / "twice"))
    a = snapshots.read(spark, str(tmp_path / "once")).select("hash_id")
    b = snapshots.read(spark, str(tmp_path / "twice")).select("hash_id")
    assert a.count() == b.count() == 20 and a.exceptAll(b).count() == 0
