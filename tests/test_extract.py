import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hitloom.functions.metrics import date_cutoff
from hitloom.operators.compact import required_key_check, to_compact
from tests.conftest import docs, session

E1 = session(visitNumber="3", totals={"visits": "1", "bounces": "1", "hits": "7"},
             trafficSource={"source": "google", "isTrueDirect": "true",
                            "adwordsClickInfo": {"page": "2", "isVideoAd": False}},
             device={"isMobile": True, "browser": "Chrome"})
E2 = {k: E1[k] for k in reversed(list(E1))}


def test_e1_integers_and_booleans_as_text_are_cast(spark):
    r = to_compact(docs(spark, E1)).collect()[0]
    assert r.visitNumber == 3 and r.visitId == 19723 and r.totals_hits == 7
    assert r.trafficSource_isTrueDirect is True
    assert r.trafficSource_adwordsClickInfo_page == 2
    assert r.trafficSource_adwordsClickInfo_isVideoAd is False
    assert r.device_isMobile is True and r.device_browser == "Chrome"
    assert str(r.date) == "2024-01-01"
    assert r.totals_newVisits is None          # missing path -> NULL


def test_e2_key_order_does_not_change_the_hash(spark):
    rows = to_compact(docs(spark, E1, E2)).select("hash_id").collect()
    assert rows[0].hash_id == rows[1].hash_id
    e3 = dict(E1, totals={"visits": "1", "bounces": "1", "hits": "8"})
    other = to_compact(docs(spark, e3)).select("hash_id").collect()[0].hash_id
    assert other != rows[0].hash_id


def test_nested_object_kept_as_variant_and_text_of_object(spark):
    r = to_compact(docs(spark, E1)).select(F.to_json("totals").alias("t")).collect()[0]
    assert r.t == '{"bounces":"1","hits":"7","visits":"1"}'


def test_e6_strict_cast_raises_and_lenient_gives_null(spark):
    bad = session(visitNumber="abc")
    with pytest.raises(PySparkException):
        to_compact(docs(spark, bad)).select("visitNumber").collect()
    r = to_compact(docs(spark, bad), strict=False).select("visitNumber").collect()[0]
    assert r.visitNumber is None


def test_e7_bad_date_raises_missing_date_is_dropped_by_cutoff(spark):
    with pytest.raises(PySparkException):
        to_compact(docs(spark, session(date="2017-08"))).select("date").collect()
    no_date = session()
    del no_date["date"]
    c = to_compact(docs(spark, no_date, session()))
    assert c.filter(date_cutoff("2024-03-01")).count() == 1


def test_e15_revenue_beyond_32_bits(spark):
    d = session(totals={"visits": "1", "totalTransactionRevenue": "3000000000000"})
    r = to_compact(docs(spark, d)).collect()[0]
    assert r.totals_totalTransactionRevenue == 3_000_000_000_000


def test_e5_required_keys_error_and_quarantine(spark):
    no_visitor = session()
    del no_visitor["fullVisitorId"]
    no_visit = session(visitor="2")
    del no_visit["visitId"]
    c = to_compact(docs(spark, session(visitor="3"), no_visitor, no_visit))
    with pytest.raises(PySparkException):
        required_key_check(c, mode="error").collect()
    good, bad = required_key_check(c, mode="quarantine")
    assert good.count() == 1 and bad.count() == 2


def test_parent_not_an_object_gives_null_fields_in_strict_mode(spark):
    d = session(totals="n/a", trafficSource=["x"], device=None)
    r = to_compact(docs(spark, d)).collect()[0]
    assert r.totals_hits is None and r.trafficSource_source is None and r.device_browser is None


def test_grouped_extraction_equals_per_path_extraction(spark):
    from hitloom.operators.compact import compact_columns
    from hitloom.plans.pipeline import stage_for
    raw = spark.read.text(stage_for(spark, "/root/testdata/sf0.001").landing) \
        .withColumnRenamed("value", "doc")
    from hitloom.sources.raw import raw_from_text
    r = raw_from_text(raw)
    a = to_compact(r).drop("totals", "trafficSource", "trafficSource_adwordsClickInfo",
                           "trafficSource_adwordsClickInfo_targetingCriteria", "device",
                           "customDimensions", "geoNetwork", "hits", "privacy_info")
    b = r.select(*compact_columns()).select(*a.columns)
    assert a.count() == raw.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


ODD = ['1', '1.0', '1.5', '1e3', '12345678901234567890', 'true', 'null', '" 7 "', '"7.0"', '"yes"', '"abc"', '""', '{"a":1}', '[1]', '-0', '"t"']


def test_one_pass_reads_odd_values_as_paths_do(spark):
    from hitloom import spec
    from hitloom.functions.variant import vget
    texts = [f'{{"fullVisitorId":{v},"visitNumber":{v},"date":{v},"totals":{{"hits":{v},"visits":"1"}},"trafficSource":{{"adwordsClickInfo":{v},'
             f'"isTrueDirect":{v},"source":{v}}},"device":{v},"customDimensions":{v},"privacy_info":null}}' for v in ODD] + ["[]", "3", '"x"', "{}"]
    raw = docs(spark, *texts)

    def shown(df, c):
        return df.select((F.to_json(c.name) if c.type == spec.VAR else F.col(c.name).cast("string")).alias(c.name))

    paths = {c.name: raw.select(vget("raw_text", c.json_path, c.type, False).alias(c.name)) for c in spec.COMPACT}
    lenient = to_compact(raw, strict=False)
    for c in [c for c in spec.COMPACT if c.path.split(".")[0] in ("fullVisitorId", "visitNumber", "date", "totals", "trafficSource", "device",
                                                                 "customDimensions", "privacy_info")]:
        assert shown(lenient, c).collect() == shown(paths[c.name], c).collect(), c.name


@pytest.mark.parametrize("path", ["visitNumber", "trafficSource.isTrueDirect"])
def test_one_pass_casts_and_raises_as_paths_do(spark, path):
    from hitloom.functions.variant import vget
    parent, _, name = path.rpartition(".")
    kind = "bigint" if path == "visitNumber" else "boolean"

    def result(df):
        try:
            return df.collect()[0][0]
        except PySparkException as e:
            return e.getCondition()

    for v in ODD:
        raw = docs(spark, f'{{"{name}":{v}}}' if not parent else f'{{"{parent}":{{"{name}":{v}}}}}')
        assert result(to_compact(raw).select(path.replace(".", "_"))) == result(raw.select(vget("raw_text", "$." + path, kind))), v
