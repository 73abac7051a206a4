"""The seven session and e-commerce reports over the compact table.

Each report is a lazy DataFrame (the equivalent of a view: ``current_date``
moves unless ``as_of`` is fixed).  All apply the date cutoff
``date <= as_of - 30 days`` first; on the date-partitioned table that is a
partition filter, and only the columns a report names are read.

Ratios are computed once from the aggregated columns with exact half-up
rounding (``ratio``); distinct session counts use Spark's distinct-aggregate
plan, whose first shuffle is keyed by (group, session) so a hot group does not
land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom.functions.metrics import date_cutoff, ratio, session_key
from hitloom.functions.variant import vpresent, vtext
from hitloom.operators.flatten import flatten

# --- Fixed values: funnel labels of the conversion path, by action type.
FUNNEL_LABELS = {
    "1": "Click through of product lists",
    "2": "Product detail views",
    "5": "Check out",
    "6": "Completed purchase",
    "7": "Refund of purchase",
}
EXCLUDED_ACTIONS = ("0", "3", "4")


def _cut(compact: DataFrame, as_of, days: int) -> DataFrame:
    return compact.filter(date_cutoff(as_of, days))


def bounce_rate_per_source(compact: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    agg = (_cut(compact, as_of, days)
           .groupBy(F.col("trafficSource_source").alias("source"))
           .agg(F.count("totals_visits").alias("total_visits"),
                F.coalesce(F.sum("totals_bounces"), F.lit(0)).alias("total_no_of_bounces")))
    return bounce_rates(agg)


def bounce_rates(agg: DataFrame) -> DataFrame:
    return (agg.select("source", "total_visits", "total_no_of_bounces",
                       ratio("total_no_of_bounces", "total_visits", 2, factor=100).alias("bounce_rate"))
            .orderBy(F.desc_nulls_first("total_visits")))


def _single_visits(compact: DataFrame, as_of, days: int) -> DataFrame:
    return _cut(compact, as_of, days).filter(F.col("totals_visits") == 1)


def country_sessions(compact: DataFrame, as_of=None, days: int = 30,
                     exact_session_key: bool = False) -> DataFrame:
    bounce = F.when(F.col("totals_bounces") == 1, F.col("totals_visits")).otherwise(F.lit(0))
    agg = (_single_visits(compact, as_of, days)
           .groupBy(F.col("geoNetwork_country").alias("country"))
           .agg(F.countDistinct(session_key(exact=exact_session_key)).alias("sessions"),
                F.sum(bounce).alias("total_bounces"),
                F.sum("totals_timeOnSite").alias("time_on_site")))
    return country_rates(agg)


def country_rates(agg: DataFrame) -> DataFrame:
    return (agg.select("country", "sessions", "total_bounces",
                       ratio("total_bounces", "sessions", 3).alias("bounce_rate"),
                       ratio("time_on_site", "sessions", 2).alias("average_session_duration_secs"))
            .orderBy(F.asc_nulls_last("country")))


def traffic_conversion(compact: DataFrame, as_of=None, days: int = 30,
                       exact_session_key: bool = False) -> DataFrame:
    agg = (_single_visits(compact, as_of, days)
           .groupBy(F.col("trafficSource_medium").alias("medium"))
           .agg(F.countDistinct(session_key(exact=exact_session_key)).alias("sessions"),
                F.sum("totals_transactions").alias("transactions"),
                F.sum("totals_totalTransactionRevenue").alias("revenue_micros"),
                F.sum("totals_bounces").alias("bounces")))
    return medium_rates(agg)


def medium_rates(agg: DataFrame) -> DataFrame:
    return (agg.select("medium", "sessions", "transactions",
                       ratio("revenue_micros", "1000000", 3).alias("total_revenue"),
                       ratio("bounces", "sessions", 3).alias("bounce_rate"),
                       ratio("transactions", "sessions", 3).alias("conversion_rate"))
            .orderBy(F.desc_nulls_first("sessions")))


def metrics_per_quarter(compact: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """``revenue`` sums transactionRevenue; ``revenue_per_visit`` uses
    totalTransactionRevenue -- two different measures, as defined."""
    agg = (_single_visits(compact, as_of, days)
           .groupBy(F.year("date").alias("year"), F.quarter("date").alias("quarter"))
           .agg(F.countDistinct("fullVisitorId").alias("users"),
                F.sum("totals_visits").alias("visits"),
                F.sum("totals_pageviews").alias("pageviews"),
                F.sum("totals_bounces").alias("bounces"),
                F.sum("totals_transactions").alias("transactions"),
                F.sum("totals_transactionRevenue").alias("revenue_micros"),
                F.sum("totals_totalTransactionRevenue").alias("total_revenue_micros")))
    return quarter_rates(agg)


def quarter_rates(agg: DataFrame) -> DataFrame:
    return (agg.select("year", "quarter", "users", "visits", "pageviews", "bounces", "transactions",
                       ratio("revenue_micros", "1000000", 2).alias("revenue"),
                       ratio("total_revenue_micros", "visits * 1000000", 2).alias("revenue_per_visit"))
            .orderBy(F.desc_nulls_first("year"), F.desc_nulls_first("quarter")))


def hits_of(compact: DataFrame, as_of=None, days: int = 30, *cols: str) -> DataFrame:
    """Date-filtered sessions flattened to one row per hit (inner), column ``hit``."""
    return flatten(_cut(compact, as_of, days).select(*cols, "hits"), "hits", "hit").drop("hits")


def conversion_path(compact: DataFrame, as_of=None, days: int = 30,
                    distinct_users: bool = False) -> DataFrame:
    """Funnel: hits x products (both inner); action types 0, 3, 4 and a
    missing action are left out, other unlabeled actions form a NULL stage.
    ``users`` counts hit-product rows unless ``distinct_users``."""
    action = vtext("hit", "$.eCommerceAction.action_type")
    hits = (hits_of(compact, as_of, days, "fullVisitorId")
            .select("fullVisitorId", action.alias("action"), "hit")
            .filter(~F.col("action").isin(*EXCLUDED_ACTIONS)))
    rows = flatten(hits, "hit", "product", path="$.product")
    users = F.countDistinct("fullVisitorId") if distinct_users else F.count("fullVisitorId")
    return funnel(rows.groupBy(stage_label("action")).agg(users.alias("users")))


def stage_label(action: str) -> Column:
    label = F.when(F.lit(False), F.lit(""))
    for code, text in FUNNEL_LABELS.items():
        label = label.when(F.col(action) == code, F.lit(text))
    return label.alias("user_action")


def funnel(stages: DataFrame) -> DataFrame:
    """Stages with their rate from the stage before."""
    # At most len(FUNNEL_LABELS) + 1 rows reach this window, so the single
    # partition of an unpartitioned window is fine.
    w = Window.orderBy(F.desc("users"), F.asc_nulls_last("user_action"))
    with_prev = stages.withColumn("prev_users", F.lag("users", 1).over(w))
    rate = F.coalesce(ratio("users", "prev_users", 2, factor=100), F.lit(100.0))
    return (with_prev.select("user_action", "users",
                             rate.alias("conversion_percent_rate_from_previous_stage"))
            .orderBy(F.desc("users"), F.asc_nulls_last("user_action")))


def promotion_ctr(compact: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Views and clicks count presence of the flag (``false`` counts too)."""
    hits = hits_of(compact, as_of, days).select(
        vpresent("hit", "$.promotionActionInfo.promoIsView").isNotNull().alias("viewed"),
        vpresent("hit", "$.promotionActionInfo.promoIsClick").isNotNull().alias("clicked"),
        "hit")
    promos = flatten(hits, "hit", "promo", path="$.promotion").select(
        vtext("promo", "$.promoName").alias("promotion_name"),
        vtext("promo", "$.promoCreative").alias("promotion_type"),
        vtext("promo", "$.promoPosition").alias("promotion_position"),
        "viewed", "clicked")
    return click_through(promos)


def click_through(promos: DataFrame) -> DataFrame:
    agg = (promos.groupBy("promotion_name", "promotion_type", "promotion_position")
           .agg(F.count_if("viewed").alias("promotion_views"),
                F.count_if("clicked").alias("promotion_clicks")))
    return click_rates(agg)


def click_rates(agg: DataFrame) -> DataFrame:
    return (agg.filter(F.col("promotion_views") > F.col("promotion_clicks"))
            .select("promotion_name", "promotion_type", "promotion_position",
                       "promotion_views", "promotion_clicks",
                       ratio("promotion_clicks", "promotion_views", 2, factor=100)
                       .alias("promotion_click_through_rate"))
            .orderBy(F.desc_nulls_first("promotion_click_through_rate")))


def unique_page_views(compact: DataFrame, as_of=None, days: int = 30,
                      title_key: str = "pagetitle", exact_session_key: bool = False) -> DataFrame:
    """Distinct sessions per (page, page + title), summed per page.

    The title key is matched exactly.  With the default spelling
    ``pagetitle`` documents that spell it ``pageTitle`` give a NULL title, the
    concatenation is NULL, and the result is distinct sessions per page;
    ``title_key="pageTitle"`` counts per title."""
    sessions = _cut(compact, as_of, days).select(
        session_key(exact=exact_session_key).alias("session"), "hits")   # once per session
    hits = flatten(sessions, "hits", "hit").select(
        "session",
        vtext("hit", "$.page.pagePath").alias("page"),
        vtext("hit", f"$.page.{title_key}").alias("title"))
    return page_views(hits)


def page_views(hits: DataFrame) -> DataFrame:
    per_title = (hits.groupBy("page", F.concat("page", "title").alias("page_concat"))
                 .agg(F.countDistinct("session").alias("unique_pageviews")))
    return (per_title.groupBy("page").agg(F.sum("unique_pageviews").alias("unique_pageviews"))
            .orderBy(F.desc_nulls_first("unique_pageviews")))


REPORTS = {
    "bounce_rate_per_source": bounce_rate_per_source,
    "country_sessions": country_sessions,
    "traffic_conversion": traffic_conversion,
    "metrics_per_quarter": metrics_per_quarter,
    "conversion_path": conversion_path,
    "promotion_ctr": promotion_ctr,
    "unique_page_views": unique_page_views,
}

# Names under which the reports are published as views.
VIEW_NAMES = {
    "bounce_rate_per_source": "bounce_rate_per_source",
    "country_sessions": "session_bounce_rate_per_country",
    "traffic_conversion": "traffic_source_metrics_conversion",
    "metrics_per_quarter": "total_metrices_per_quarter",
    "conversion_path": "conversion_path_for_user",
    "promotion_ctr": "promotion_click_through_rate",
    "unique_page_views": "unique_page_views",
}


def run_all(compact: DataFrame, as_of=None, hits: DataFrame | None = None) -> dict[str, DataFrame]:
    """All reports (``plans.views`` publishes them as views).  Given the per-hit table, the
    three hit-level reports scan that instead of flattening the ``hits`` blobs."""
    out = {name: fn(compact, as_of) for name, fn in REPORTS.items()}
    if hits is not None:
        from hitloom.plans.hit_reports import HIT_REPORTS
        out |= {name: fn(hits, as_of) for name, fn in HIT_REPORTS.items()}
    return out
