from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from hitloom.functions.metrics import ratio
from hitloom.operators.compact import to_compact
from hitloom.plans import reports
from tests.conftest import docs, session

AS_OF = "2024-02-20"       # cutoff 2024-01-21


def _c(spark, *ds):
    return to_compact(docs(spark, *ds))


def _hit(action=None, products=1, **extra):
    h = {"product": [{"productSKU": str(i)} for i in range(products)]}
    if action is not None:
        h["eCommerceAction"] = {"action_type": action}
    h.update(extra)
    return h


def test_e11_conversion_path_labels_exclusions_and_null_stage(spark):
    hits = [_hit(str(a)) for a in range(9)] + [_hit(None)]
    out = {r.user_action: r.users for r in
           reports.conversion_path(_c(spark, session(hits=hits)), AS_OF).collect()}
    # 0, 3, 4 and the missing action are dropped; 8 has no label -> NULL stage
    assert out == {"Click through of product lists": 1, "Product detail views": 1,
                   "Check out": 1, "Completed purchase": 1, "Refund of purchase": 1, None: 1}


def test_e17_lag_rate_tie_break_and_first_row(spark):
    hits = [_hit("1", 2), _hit("2", 2), _hit("5", 1)]
    rows = reports.conversion_path(_c(spark, session(hits=hits)), AS_OF).collect()
    assert [(r.user_action, r.users) for r in rows] == [
        ("Click through of product lists", 2), ("Product detail views", 2), ("Check out", 1)]
    assert [r.conversion_percent_rate_from_previous_stage for r in rows] == [100.0, 100.0, 50.0]


def test_e17_cutoff_is_inclusive_and_keeps_old_data_only(spark):
    ds = [session(visitor=v, date=d) for v, d in (("a", "20240120"), ("b", "20240121"),
                                                  ("c", "20240122"))]
    kept = reports.bounce_rate_per_source(_c(spark, *ds), AS_OF).collect()[0]
    assert kept.total_visits == 2


def test_e12_promotion_counts_presence_not_truth(spark):
    promo = [{"promoName": "p", "promoCreative": "c", "promoPosition": "top"}]
    hits = [_hit(promotion=promo, promotionActionInfo={"promoIsView": True}),
            _hit(promotion=promo, promotionActionInfo={"promoIsView": False}),
            _hit(promotion=promo, promotionActionInfo={"promoIsView": None}),
            _hit(promotion=promo, promotionActionInfo={"promoIsView": True, "promoIsClick": True}),
            _hit(promotion=promo)]
    r = reports.promotion_ctr(_c(spark, session(hits=hits)), AS_OF).collect()[0]
    assert (r.promotion_views, r.promotion_clicks) == (4, 1)
    assert r.promotion_click_through_rate == 25.0


def test_e13_title_key_spelling(spark):
    hits = [{"page": {"pagePath": "/a", "pageTitle": "A"}},
            {"page": {"pagePath": "/a", "pageTitle": "B"}}]
    c = _c(spark, session(hits=hits))
    assert reports.unique_page_views(c, AS_OF).collect()[0].unique_pageviews == 1
    titled = reports.unique_page_views(c, AS_OF, title_key="pageTitle").collect()[0]
    assert titled.unique_pageviews == 2


def test_e14_zero_visits_gives_null_rate(spark):
    d = session(trafficSource={"source": "x"}, totals={"bounces": "1"})
    r = reports.bounce_rate_per_source(_c(spark, d), AS_OF).collect()[0]
    assert (r.total_visits, r.total_no_of_bounces, r.bounce_rate) == (0, 1, None)


def test_e16_session_key_collision_and_exact_option(spark):
    ds = [session(visitor="1", visit="23"), session(visitor="12", visit="3")]
    c = _c(spark, *ds)
    assert reports.traffic_conversion(c, AS_OF).collect()[0].sessions == 1
    assert reports.traffic_conversion(c, AS_OF, exact_session_key=True).collect()[0].sessions == 2


def test_e15_revenue_report_uses_64_bit_sums(spark):
    d = session(totals={"visits": "1", "transactions": "1",
                        "totalTransactionRevenue": "3000000000000",
                        "transactionRevenue": "2999999995000"})
    r = reports.metrics_per_quarter(_c(spark, d), AS_OF).collect()[0]
    assert r.revenue == 2999999.995 or r.revenue == 3000000.0
    assert r.revenue_per_visit == 3000000.0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 10**6)), min_size=1, max_size=20),
       st.sampled_from([(2, 1), (3, 1), (2, 100)]))
def test_ratio_is_exact_half_up(spark, pairs, scale_factor):
    scale, factor = scale_factor
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    got = [r.q for r in df.select(ratio("n", "d", scale, factor).alias("q")).collect()]
    for (n, d), q in zip(pairs, got):
        if d == 0:
            assert q is None
            continue
        exact = Fraction(n * factor, d)
        units = int(exact * 10 ** scale + Fraction(1, 2))
        assert q == units / 10 ** scale


def test_report_schemas(spark):
    c = _c(spark, session(hits=[_hit("1")]))
    out = reports.run_all(c, AS_OF)
    assert out["metrics_per_quarter"].dtypes[:2] == [("year", "int"), ("quarter", "int")]
    for name in ("bounce_rate_per_source", "country_sessions", "traffic_conversion"):
        assert dict(out[name].dtypes)["bounce_rate"] == "double"
    assert out["conversion_path"].count() == 1
