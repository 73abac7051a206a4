"""The seven reports published as views that follow their table.

A view is SQL text over the files' paths.  Spark analyses that text anew in
every query: the table's newest pointer is resolved and its files are listed
then, and ``current_date()`` is that day's, so a view created once answers with
what the table holds when it is asked, after appends and after replacements,
whichever process wrote them.  (A view made from a DataFrame would keep the file
list of the moment it was created.)

Names are arguments: ``names`` renames single views, ``prefix`` all of them, and
``schema`` creates persistent views there instead of temporary ones, so two
warehouses in one session do not get in each other's way.
"""

from __future__ import annotations

import datetime

from pyspark.sql import SparkSession

from hitloom.functions.metrics import ratio_sql
from hitloom.operators.snapshots import source_sql
from hitloom.operators.upsert import PARTITION_COLUMN
from hitloom.plans.reports import EXCLUDED_ACTIONS, FUNNEL_LABELS, VIEW_NAMES

_SESSION = "concat(fullVisitorId, CAST(visitId AS STRING))"
_EXACT_SESSION = "concat_ws('\\u0001', fullVisitorId, CAST(visitId AS STRING))"


def _elements(value: str) -> str:
    return (f"coalesce(try_variant_get({value}, '$', 'array<variant>'), "
            f"map_values(try_variant_get({value}, '$', 'map<string,variant>')))")


def _text(value: str, path: str) -> str:
    return f"try_variant_get({value}, '{path}', 'string')"


def _has(value: str, path: str) -> str:
    return f"variant_get({value}, '{path}', 'variant') IS NOT NULL"


def _labels(action: str) -> str:
    cases = " ".join(f"WHEN {action} = '{code}' THEN '{label}'" for code, label in FUNNEL_LABELS.items())
    return f"CASE {cases} END"


def _funnel(stages: str) -> str:
    rate = ratio_sql("users", "prev_users", 2, factor=100)
    return f"""
SELECT user_action, users, coalesce({rate}, 100.0D) AS conversion_percent_rate_from_previous_stage
FROM (SELECT *, lag(users, 1) OVER (ORDER BY users DESC, user_action ASC NULLS LAST) AS prev_users FROM ({stages}))
ORDER BY users DESC, user_action ASC NULLS LAST"""


def _click_through(promotions: str) -> str:
    return f"""
SELECT promotion_name, promotion_type, promotion_position, promotion_views, promotion_clicks,
       {ratio_sql('promotion_clicks', 'promotion_views', 2, factor=100)} AS promotion_click_through_rate
FROM (SELECT promotion_name, promotion_type, promotion_position, count_if(viewed) AS promotion_views, count_if(clicked) AS promotion_clicks
      FROM ({promotions}) GROUP BY promotion_name, promotion_type, promotion_position
      HAVING promotion_views > promotion_clicks)
ORDER BY promotion_click_through_rate DESC NULLS FIRST"""


def _page_views(hits: str) -> str:
    return f"""
SELECT page, sum(unique_pageviews) AS unique_pageviews
FROM (SELECT page, concat(page, title) AS page_concat, count(DISTINCT session) AS unique_pageviews FROM ({hits}) GROUP BY ALL)
GROUP BY page ORDER BY unique_pageviews DESC NULLS FIRST"""


def report_sql(source: str, as_of: str | datetime.date | None = None, days: int = 30, exact_session_key: bool = False,
               distinct_users: bool = False, title_key: str = "pagetitle", hits: str | None = None) -> dict[str, str]:
    """The text of every report over ``source`` (a table name or a query in parentheses with the compact
    columns).  Without ``as_of`` the cutoff moves with the day of the query.  Given ``hits``, the three
    hit-level reports read the per-hit table there."""
    limit = f"date_sub(current_date(), {int(days)})"
    if as_of is not None:
        limit = f"DATE '{datetime.date.fromisoformat(str(as_of)) - datetime.timedelta(days=days)}'"
    if not title_key.isalnum():
        raise ValueError(f"not a title key: {title_key!r}")
    old = f"date <= {limit}"
    session = _EXACT_SESSION if exact_session_key else _SESSION
    single = f"{source} WHERE {old} AND totals_visits = 1"
    out = {
        "bounce_rate_per_source": f"""
SELECT source, total_visits, total_no_of_bounces, {ratio_sql('total_no_of_bounces', 'total_visits', 2, factor=100)} AS bounce_rate
FROM (SELECT trafficSource_source AS source, count(totals_visits) AS total_visits, coalesce(sum(totals_bounces), 0) AS total_no_of_bounces
      FROM {source} WHERE {old} GROUP BY trafficSource_source)
ORDER BY total_visits DESC NULLS FIRST""",
        "country_sessions": f"""
SELECT country, sessions, total_bounces, {ratio_sql('total_bounces', 'sessions', 3)} AS bounce_rate,
       {ratio_sql('time_on_site', 'sessions', 2)} AS average_session_duration_secs
FROM (SELECT geoNetwork_country AS country, count(DISTINCT {session}) AS sessions,
             sum(CASE WHEN totals_bounces = 1 THEN totals_visits ELSE 0 END) AS total_bounces, sum(totals_timeOnSite) AS time_on_site
      FROM {single} GROUP BY geoNetwork_country)
ORDER BY country ASC NULLS LAST""",
        "traffic_conversion": f"""
SELECT medium, sessions, transactions, {ratio_sql('revenue_micros', '1000000', 3)} AS total_revenue,
       {ratio_sql('bounces', 'sessions', 3)} AS bounce_rate, {ratio_sql('transactions', 'sessions', 3)} AS conversion_rate
FROM (SELECT trafficSource_medium AS medium, count(DISTINCT {session}) AS sessions, sum(totals_transactions) AS transactions,
             sum(totals_totalTransactionRevenue) AS revenue_micros, sum(totals_bounces) AS bounces
      FROM {single} GROUP BY trafficSource_medium)
ORDER BY sessions DESC NULLS FIRST""",
        "metrics_per_quarter": f"""
SELECT year, quarter, users, visits, pageviews, bounces, transactions, {ratio_sql('revenue_micros', '1000000', 2)} AS revenue,
       {ratio_sql('total_revenue_micros', 'visits * 1000000', 2)} AS revenue_per_visit
FROM (SELECT year(date) AS year, quarter(date) AS quarter, count(DISTINCT fullVisitorId) AS users, sum(totals_visits) AS visits,
             sum(totals_pageviews) AS pageviews, sum(totals_bounces) AS bounces, sum(totals_transactions) AS transactions,
             sum(totals_transactionRevenue) AS revenue_micros, sum(totals_totalTransactionRevenue) AS total_revenue_micros
      FROM {single} GROUP BY ALL)
ORDER BY year DESC NULLS FIRST, quarter DESC NULLS FIRST""",
    }
    excluded = ", ".join(f"'{a}'" for a in EXCLUDED_ACTIONS)
    if hits is None:
        users = "count(DISTINCT fullVisitorId)" if distinct_users else "count(fullVisitorId)"
        per_hit = lambda columns: f"(SELECT {columns}, hits FROM {source} WHERE {old}) LATERAL VIEW explode({_elements('hits')}) h AS hit"
        action = f"(SELECT fullVisitorId, hit, {_text('hit', '$.eCommerceAction.action_type')} AS action FROM {per_hit('fullVisitorId')})"
        product = "variant_get(hit, '$.product', 'variant')"
        stages = (f"SELECT {_labels('action')} AS user_action, {users} AS users FROM (SELECT * FROM {action} WHERE action NOT IN ({excluded})) "
                  f"LATERAL VIEW explode({_elements(product)}) p AS product GROUP BY 1")
        promotion = "variant_get(hit, '$.promotion', 'variant')"
        promotions = (f"SELECT {_text('promo', '$.promoName')} AS promotion_name, {_text('promo', '$.promoCreative')} AS promotion_type, "
                      f"{_text('promo', '$.promoPosition')} AS promotion_position, viewed, clicked FROM (SELECT hit, "
                      f"{_has('hit', '$.promotionActionInfo.promoIsView')} AS viewed, {_has('hit', '$.promotionActionInfo.promoIsClick')} AS clicked "
                      f"FROM {per_hit('1')}) LATERAL VIEW explode({_elements(promotion)}) p AS promo")
        pages = (f"SELECT session, {_text('hit', '$.page.pagePath')} AS page, {_text('hit', f'$.page.{title_key}')} AS title "
                 f"FROM {per_hit(f'{session} AS session')}")
    else:
        users = "count(DISTINCT fullVisitorId)" if distinct_users else "CAST(sum(n_products) AS BIGINT)"
        stages = (f"SELECT {_labels('action')} AS user_action, {users} AS users FROM {hits} WHERE {old} AND action NOT IN ({excluded}) "
                  "AND n_products > 0 AND fullVisitorId IS NOT NULL GROUP BY 1")
        promotions = ("SELECT p.name AS promotion_name, p.creative AS promotion_type, p.position AS promotion_position, viewed, clicked "
                      f"FROM (SELECT * FROM {hits} WHERE {old}) LATERAL VIEW explode(promotions) x AS p")
        title = {"pagetitle": "page_title_lower", "pageTitle": "page_title"}[title_key]
        pages = f"SELECT {session} AS session, page_path AS page, {title} AS title FROM {hits} WHERE {old}"
    return out | {"conversion_path": _funnel(stages), "promotion_ctr": _click_through(promotions), "unique_page_views": _page_views(pages)}


def publish_views(spark: SparkSession, compact_path: str, as_of: str | datetime.date | None = None, names: dict[str, str] | None = None,
                  prefix: str = "", schema: str | None = None, hits_path: str | None = None, **options) -> dict[str, str]:
    """Create or replace the seven views over the table at ``compact_path``; returns report -> view name.

    ``options`` go to ``report_sql``.  With ``schema`` the views are persistent (in a session with a
    persistent catalog they outlive it), else temporary."""
    unknown = set(names or {}) - set(VIEW_NAMES)
    if unknown:
        raise ValueError(f"no such report: {', '.join(sorted(unknown))}")
    hits = None if hits_path is None else source_sql(hits_path, PARTITION_COLUMN)
    texts = report_sql(source_sql(compact_path, PARTITION_COLUMN), as_of, hits=hits, **options)
    out = {}
    for report, text in texts.items():
        name = prefix + {**VIEW_NAMES, **(names or {})}[report]
        out[report] = f"`{schema}`.`{name}`" if schema else f"`{name}`"
        spark.sql(f"CREATE OR REPLACE {'' if schema else 'TEMPORARY '}VIEW {out[report]} AS {text}")
    return out
