from pyspark.sql import functions as F

from hitloom.functions.variant import vtext
from hitloom.operators.compact import to_compact
from hitloom.operators.explode import explode_sessions
from hitloom.operators.flatten import flatten
from tests.conftest import docs, session


def _raw(spark, *ds):
    return to_compact(docs(spark, *ds))


def test_e8_inner_drops_missing_null_and_empty_outer_keeps(spark):
    ds = [session(visitor="a", hits=[{"hitNumber": "1"}]),
          session(visitor="b"),                       # missing
          session(visitor="c", hits=None),            # JSON null
          session(visitor="d", hits=[])]              # empty
    c = _raw(spark, *ds)
    inner = flatten(c, "hits", "hit").select("fullVisitorId").collect()
    assert [r.fullVisitorId for r in inner] == ["a"]
    outer = flatten(c, "hits", "hit", outer=True).select("fullVisitorId", "hit")
    assert outer.count() == 4
    assert outer.filter(F.col("hit").isNull()).count() == 3


def test_nested_flatten_and_index(spark):
    c = _raw(spark, session(hits=[{"product": [{"productSKU": "x"}, {"productSKU": "y"}]},
                                  {"product": [{"productSKU": "z"}]}]))
    hits = flatten(c, "hits", "hit", with_index=True)
    prods = flatten(hits, "hit", "p", path="$.product")
    got = sorted((r.hit_index, r.sku) for r in prods.select("hit_index", vtext("p", "$.productSKU")
                                                               .alias("sku")).collect())
    assert got == [(0, "x"), (0, "y"), (1, "z")]


def test_object_flattens_into_its_values(spark):
    c = _raw(spark, session(hits=[{"page": {"a": "1", "b": "2"}}]))
    hits = flatten(c, "hits", "hit")
    vals = flatten(hits, "hit", "v", path="$.page").select(vtext("v", "$").alias("x")).collect()
    assert sorted(r.x for r in vals) == ["1", "2"]


def _m(n):
    return max(1, n)


def test_e9_e10_fanout_row_count_formula(spark):
    hit_a = {"hitNumber": "1",
             "promotion": [{"promoName": "p1"}, {"promoName": "p2"}],
             "product": [{"productSKU": "s0"},
                         {"productSKU": "s1", "customDimensions": [{"index": "1", "value": "v"}]},
                         {"productSKU": "s2", "customDimensions": [{"index": "1", "value": "v"},
                                                                   {"index": "2", "value": "w"}],
                          "customMetrics": [{"index": "1", "value": "5"}, {"index": "2", "value": "6"}]}],
             "experiment": [{"experimentId": "e"}]}
    hit_b = {"hitNumber": "2", "product": [{"productSKU": "s9"}]}       # E9: no promotion
    d = session(hits=[hit_a, hit_b], customDimensions=[{"index": "1", "value": "a"},
                                                       {"index": "2", "value": "b"}])
    ex = explode_sessions(_raw(spark, d))
    # promotions x m(session dims) x m(experiments) x sum over products m(dims)*m(metrics)
    expect = 2 * _m(2) * _m(1) * (_m(0) * _m(0) + _m(1) * _m(0) + _m(2) * _m(2))
    assert ex.count() == expect
    assert ex.filter(F.col("hits_hitNumber") == 2).count() == 0       # inner on promotions
    assert explode_sessions(_raw(spark, d), outer_promotions=True) \
        .filter(F.col("hits_hitNumber") == 2).count() == 2
    assert len(ex.columns) == 267
    # drop_unused skips the product custom-metric flatten (rows, not columns)
    assert explode_sessions(_raw(spark, d), drop_unused=True).count() == 2 * 2 * (1 + 1 + 2)
