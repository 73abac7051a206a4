"""Session documents derived from the driver's ``events`` table.

A session is one user's events in one slot of ``SLOT_HOURS`` hours, counted
from 1970; its number is the visit id.  Every field is arithmetic on the
event's ``k`` (from ``props``) or on ``user_id``, so an SQL oracle can recompute
any report straight from the flat table.  Integers are written as JSON text on
purpose: exports of this kind often do that, and the strict casts must accept it.

The boundary of a document is a rule on time, not on its size, so documents
are the same whatever the data holds; a user with very many events has them in
many slots, which are grouped apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.sources.tables import spread, table

# --- Fixed values of the fixture rules.
SLOT_HOURS = 6
MEDIUMS = ["organic", "cpc", "referral", "email"]
DEVICE_CATEGORIES = ["desktop", "mobile", "tablet"]
ACTION_BY_EVENT = {"click": "1", "view": "2", "signup": "5", "purchase": "6"}
PURCHASE_FEE_MICROS = 5_000_000


def _txt(c: Column) -> Column:
    return c.cast("string")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _upto3(n: Column, make) -> Column:
    """Array of the first ``n`` (0..3) elements ``make(i)``."""
    return F.slice(F.transform(F.sequence(F.lit(0), F.lit(2)), make), 1, n)


def _action(et: Column, k: Column) -> Column:
    out = None
    for event, code in ACTION_BY_EVENT.items():
        out = (F.when if out is None else out.when)(et == event, F.lit(code))
    return out.when((et == "error") & (k % 4 == 0), F.lit("0")) \
              .when((et == "error") & (k % 4 == 1), F.lit("8"))


def hit_struct() -> Column:
    """The hit object of one event (without hitNumber/time, set per document)."""
    k = F.col("k")
    et = F.col("event_type")
    action = _action(et, k)
    product = F.when(k % 10 != 0, _upto3(k % 3, lambda i: F.struct(
        _txt(k + i).alias("productSKU"),
        F.concat(F.lit("SKU"), _txt(k + i)).alias("v2ProductName"),
        F.lit("1").alias("productQuantity"),
        F.slice(F.array(F.struct(F.lit("1").alias("index"), F.concat(F.lit("pd"), _txt(k + i)).alias("value"))),
                1, ((k + i) % 2).cast("int")).alias("customDimensions"),
        _upto3(((k + i) % 3).cast("int"), lambda j: F.struct(_txt(j + 1).alias("index"), _txt(k + j).alias("value")))
        .alias("customMetrics"),
    )))
    promotion = _upto3((F.floor(k / 3) % 3).cast("int"), lambda i: F.struct(
        F.concat(F.lit("promo"), _txt((k + i) % 5)).alias("promoName"),
        F.concat(F.lit("c"), _txt(k % 2)).alias("promoCreative"),
        F.concat(F.lit("pos"), _txt(i)).alias("promoPosition"),
        F.concat(F.lit("id"), _txt(k + i)).alias("promoId"),
    ))
    is_view = F.when(et.isin("view", "error"), F.lit(True)).when(et == "signup", F.lit(False))
    is_click = F.when(et == "click", F.lit(True))
    pai = F.when(is_view.isNotNull() | is_click.isNotNull(),
                 F.struct(is_view.alias("promoIsView"), is_click.alias("promoIsClick")))
    experiment = F.slice(F.array(F.struct(F.concat(F.lit("exp"), _txt(k % 7)).alias("experimentId"),
                                          _txt(k % 2).alias("experimentVariant"))), 1, (k % 2).cast("int"))
    hit_dims = F.slice(F.array(F.struct(F.lit("1").alias("index"), F.concat(F.lit("hd"), _txt(k % 4)).alias("value"))),
                       1, (F.floor(k / 2) % 2).cast("int"))
    transaction = F.when(et == "purchase", F.struct(
        F.concat(F.lit("T"), _txt(F.col("event_id"))).alias("transactionId"),
        _txt(F.col("rev_micros")).alias("transactionRevenue")))
    return F.struct(
        F.when(et == "view", F.lit("PAGE")).otherwise(F.lit("EVENT")).alias("type"),
        _txt(F.hour("ts")).alias("hour"),
        _txt(F.minute("ts")).alias("minute"),
        F.struct(F.concat(F.lit("/p"), _txt(k % 12)).alias("pagePath"),
                 F.concat(F.lit("T"), _txt(k % 5)).alias("pageTitle")).alias("page"),
        F.when(action.isNotNull(), F.struct(action.alias("action_type"))).alias("eCommerceAction"),
        product.alias("product"),
        promotion.alias("promotion"),
        pai.alias("promotionActionInfo"),
        experiment.alias("experiment"),
        hit_dims.alias("customDimensions"),
        transaction.alias("transaction"),
    )


def events_prepared(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id", "user_id", "event_type", "ts",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.to_date(ts).alias("day"),
        F.unix_micros(ts).alias("us"),
        F.expr(f"unix_micros(cast(ts AS timestamp)) div {SLOT_HOURS * 3_600_000_000}").alias("slot"),
        F.when(F.col("event_type") == "purchase",
               (F.round(F.col("value") * 100).cast("bigint") * 10000)).alias("rev_micros"),
    )


def session_docs(events: DataFrame, nation: DataFrame, region: DataFrame | None = None) -> DataFrame:
    """One JSON document per session: columns (user_id, day, slot, doc)."""
    # Flat events are shuffled, and a document is one aggregate over them: hits are built where they are grouped.
    # A missing user or time makes no session.
    per = ["user_id", "day", "slot"]
    ev = spread(events_prepared(events).dropna(subset=per), *per)
    view, purchase = (F.sum(F.when(F.col("event_type") == t, 1).otherwise(0)) for t in ("view", "purchase"))
    sess = ev.groupBy(*per).agg(
        F.count(F.lit(1)).alias("n"), F.min("us").alias("us0"), F.max("us").alias("us1"),
        view.alias("views"), purchase.alias("purchases"), F.sum("rev_micros").alias("rev"),
        F.array_sort(F.collect_list(F.struct("us", "event_id", hit_struct().alias("h")))).alias("es"))
    sess = sess.withColumn("hits", F.transform("es", lambda e, i: e["h"].withField(
        "hitNumber", _txt(i + 1)).withField("time", _txt(F.floor((e["us"] - F.col("us0")) / 1000))))).drop("es")

    nat = nation.select(F.col("n_nationkey").cast("bigint").alias("nk"), "n_name", "n_regionkey")
    if region is not None:
        nat = nat.join(region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey", "left")
    else:
        nat = nat.withColumn("r_name", F.lit(None).cast("string"))
    # nation is a fixed 25-row dimension: Catalyst broadcasts it by its size.
    s = sess.join(nat, F.col("user_id") % 25 == F.col("nk"), "left")

    uid = F.col("user_id")
    one_event = F.col("n") == 1
    totals = F.struct(
        F.when(uid % 11 != 0, F.lit("1")).alias("visits"),
        F.when(one_event, F.lit("1")).alias("bounces"),
        _txt(F.col("n")).alias("hits"),
        _txt(F.col("views")).alias("pageviews"),
        F.when(~one_event, _txt(F.expr("(us1 - us0) div 1000000"))).alias("timeOnSite"),
        F.when(F.col("purchases") > 0, _txt(F.col("purchases"))).alias("transactions"),
        _txt(F.col("rev")).alias("transactionRevenue"),
        _txt(F.col("rev") + F.col("purchases") * PURCHASE_FEE_MICROS).alias("totalTransactionRevenue"),
    )
    docs = s.select(
        *per, "hits",
        totals.alias("totals"),
        F.struct(F.when(uid % 13 != 0, F.concat(F.lit("src"), _txt(uid % 7))).alias("source"),
                 _pick(MEDIUMS, uid % 4).alias("medium")).alias("trafficSource"),
        F.struct(_pick(DEVICE_CATEGORIES, uid % 3).alias("deviceCategory"),
                 (uid % 3 == 1).alias("isMobile")).alias("device"),
        F.struct(F.col("r_name").alias("continent"), F.col("n_name").alias("country")).alias("geoNetwork"),
        F.expr("us0 div 1000000").alias("start_s"),
    )
    doc = F.struct(
        F.concat(F.lit("cid"), _txt(uid)).alias("clientId"),
        _txt(uid).alias("fullVisitorId"),
        _txt(F.dayofmonth("day")).alias("visitNumber"),
        _txt(F.col("slot")).alias("visitId"),
        _txt(F.col("start_s")).alias("visitStartTime"),
        F.date_format("day", "yyyyMMdd").alias("date"),
        F.col("totals"),
        F.col("trafficSource"),
        F.col("device"),
        _upto3((uid % 3).cast("int"), lambda i: F.struct(
            _txt(i + 1).alias("index"), F.concat(F.lit("cd"), _txt((uid + i) % 4)).alias("value"))).alias("customDimensions"),
        F.col("geoNetwork"),
        F.col("hits"),
    )
    return docs.select(*per, F.to_json(doc).alias("doc"))


def session_docs_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_docs(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"),
                        table(spark, sf_dir, "region"))
