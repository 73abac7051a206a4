"""A per-hit stage table and the three hit-level reports over it.

The hit-level reports over the compact table read and flatten the whole
``hits`` blob on every evaluation.  This table holds one row per hit with
just the typed fields those reports use, written once per load (partitioned
by date, refreshed for the dates an upsert touched), so the reports become
narrow column scans.  Results equal the compact-based reports (tested).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.functions.metrics import date_cutoff, session_key
from hitloom.functions.variant import vpresent, vtext
from hitloom.operators.flatten import elements, flatten
from hitloom.plans.reports import EXCLUDED_ACTIONS, click_through, funnel, page_views, stage_label


def build_hits(compact: DataFrame) -> DataFrame:
    """One row per hit (inner flatten) with the report fields, typed."""
    hits = flatten(compact.select("fullVisitorId", "visitId", "date", "hits"), "hits", "hit")
    promos = elements(F.variant_get(F.col("hit"), "$.promotion", "variant"))
    return hits.select(
        "fullVisitorId", "visitId", "date",
        vtext("hit", "$.eCommerceAction.action_type").alias("action"),
        F.coalesce(F.size(elements(F.variant_get(F.col("hit"), "$.product", "variant"))),
                   F.lit(0)).alias("n_products"),
        vtext("hit", "$.page.pagePath").alias("page_path"),
        vtext("hit", "$.page.pageTitle").alias("page_title"),
        vtext("hit", "$.page.pagetitle").alias("page_title_lower"),
        vpresent("hit", "$.promotionActionInfo.promoIsView").isNotNull().alias("viewed"),
        vpresent("hit", "$.promotionActionInfo.promoIsClick").isNotNull().alias("clicked"),
        F.transform(promos, lambda p: F.struct(
            vtext(p, "$.promoName").alias("name"),
            vtext(p, "$.promoCreative").alias("creative"),
            vtext(p, "$.promoPosition").alias("position"))).alias("promotions"),
    )


def refresh_hits(spark: SparkSession, compact_path: str, hits_path: str, full: bool = False) -> None:
    """Whole rebuild, or only the dates that changed since the last one."""
    import sys

    from hitloom.functions import variant
    from hitloom.operators import flatten as flatten_module
    from hitloom.plans.pipeline import build_signature, refresh_derived
    signature = build_signature([variant, flatten_module, sys.modules[__name__]])
    refresh_derived(spark, compact_path, hits_path, build_hits, full, signature)


def conversion_path(hits: DataFrame, as_of=None, days: int = 30,
                    distinct_users: bool = False) -> DataFrame:
    """Same as the compact-based report: ``users`` counts hit-product rows,
    i.e. the sum of product counts of the qualifying hits."""
    users = (F.countDistinct("fullVisitorId") if distinct_users
             else F.sum("n_products").cast("bigint"))
    rows = hits.filter(date_cutoff(as_of, days) & ~F.col("action").isin(*EXCLUDED_ACTIONS)
                       & (F.col("n_products") > 0) & F.col("fullVisitorId").isNotNull())
    return funnel(rows.groupBy(stage_label("action")).agg(users.alias("users")))


def promotion_ctr(hits: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    promos = (hits.filter(date_cutoff(as_of, days))
              .select("viewed", "clicked", F.explode("promotions").alias("p")))
    return click_through(promos.select(
        F.col("p.name").alias("promotion_name"), F.col("p.creative").alias("promotion_type"),
        F.col("p.position").alias("promotion_position"), "viewed", "clicked"))


def unique_page_views(hits: DataFrame, as_of=None, days: int = 30,
                      title_key: str = "pagetitle", exact_session_key: bool = False) -> DataFrame:
    """``title_key`` is ``pagetitle`` (as the report is written) or
    ``pageTitle``; the table keeps both spellings."""
    title = {"pagetitle": "page_title_lower", "pageTitle": "page_title"}[title_key]
    return page_views(hits.filter(date_cutoff(as_of, days)).select(
        session_key(exact=exact_session_key).alias("session"),
        F.col("page_path").alias("page"), F.col(title).alias("title")))


HIT_REPORTS = {
    "conversion_path": conversion_path,
    "promotion_ctr": promotion_ctr,
    "unique_page_views": unique_page_views,
}
