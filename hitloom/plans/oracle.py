"""Independent SQL (DuckDB dialect) for every catalogue query.

These read the flat driver tables only and restate the fixture rules of
``hitloom.sources.fixtures`` in SQL; they never see a JSON document.
"""

from __future__ import annotations

# Stated here a second time on purpose: an error in the engine's own values must show.
CUTOFF = "2024-01-21"

# Types of the 267 exploded columns in order (text, integer, boolean, date, variant).
COLUMN_TYPES = (
    "TTTTIIIDVIIIIIIIIIIIIIVTVITIIITITBITVITTBTTTTTTVTTTTTTTTTTBTTBTTTVITVTTTTTTTTTTTVTTTVITTT"
    "VTTVTTIVTBIIIIBBBBVIIIIIIIIIIITTIITIVTTTTTTTTTVTIIITTIIITVTTTTIITIVTVTTTTTTTTVTTTIVTTTTVB"
    "BVIIVTTVIIIIIIIIIIIIIIIIIITTIIIITIIIIIVITTVITVIIVTTTTITTIVTTTTTTTTTTTVITVIIITIIIITTTTBBTI")


def _all_columns() -> str:
    """Every scalar column by its position alone; see ``sources.full_docs``."""
    values = []
    for i, kind in enumerate(COLUMN_TYPES, 1):
        n = f"(event_id + {i})"
        text = {"T": f"'t{i}_' || event_id % 5", "I": f"{n} % 1000", "B": f"{n} % 2 = 0"}.get(kind)
        if kind == "D":
            values.append("CAST(CAST(ts AS DATE) AS VARCHAR)")
        elif i == 2:            # visitor
            values.append("CAST(event_id AS VARCHAR)")
        elif i == 6:            # visit number, never missing
            values.append(f"CAST({text} AS VARCHAR)")
        elif text:
            values.append(f"CASE WHEN {n} % 7 = 3 THEN '~' ELSE CAST({text} AS VARCHAR) END")
    half = len(values) // 2
    return (f"SELECT CAST(event_id AS VARCHAR) AS visitor, md5(concat_ws('|', {', '.join(values[:half])})) AS first_half, "
            f"md5(concat_ws('|', {', '.join(values[half:])})) AS second_half, "
            f"CAST({COLUMN_TYPES.count('V')} AS INTEGER) AS blobs FROM events")


def half_up(num: str, den: str, scale: int, factor: int = 1) -> str:
    """``round(factor*num/den, scale)``, halves away from zero, by whole quotient
    and remainder; NULL on a zero or NULL denominator."""
    unit = 10 ** scale
    n, d = f"(CAST(({num}) AS HUGEINT) * {factor * unit})", f"CAST(NULLIF(({den}), 0) AS HUGEINT)"
    whole = f"(abs({n}) // abs({d}))"
    more = f"(CASE WHEN 2 * (abs({n}) % abs({d})) >= abs({d}) THEN 1 ELSE 0 END)"
    return f"(CAST(sign({n}) * sign({d}) AS DOUBLE) * ({whole} + {more}) / {unit})"


# Events as hits, with every fixture quantity derived from k and user_id.
_EV = """
ev AS (
  SELECT event_id, user_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(ts AS DATE) AS day,
         epoch_us(ts) AS us, epoch_us(ts) // 21600000000 AS slot,
         CASE WHEN event_type = 'purchase'
              THEN CAST(round(value * 100) AS BIGINT) * 10000 END AS rev_micros
  FROM events
),
hit AS (
  SELECT *,
         CAST(user_id AS VARCHAR) AS fullVisitorId,
         slot AS visitId,
         CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '2' WHEN 'signup' THEN '5'
                         WHEN 'purchase' THEN '6'
                         ELSE CASE WHEN k % 4 = 0 THEN '0' WHEN k % 4 = 1 THEN '8' END END AS action,
         CASE WHEN k % 10 <> 0 THEN k % 3 ELSE 0 END AS n_products,
         (k // 3) % 3 AS n_promotions,
         k % 2 AS n_experiments,
         (k // 2) % 2 AS n_hit_dims,
         row_number() OVER (PARTITION BY user_id, slot ORDER BY ts, event_id) AS hit_number
  FROM ev
),
sess AS (
  SELECT user_id, day, slot,
         COUNT(*) AS n, MIN(us) AS us0, MAX(us) AS us1,
         SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS views,
         SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchases,
         SUM(rev_micros) AS rev
  FROM ev GROUP BY user_id, day, slot
),
compact AS (
  SELECT CAST(s.user_id AS VARCHAR) AS fullVisitorId,
         s.slot AS visitId,
         s.day AS date,
         CAST(dayofmonth(s.day) AS BIGINT) AS visitNumber,
         s.us0 // 1000000 AS visitStartTime,
         CASE WHEN s.user_id % 11 <> 0 THEN CAST(1 AS BIGINT) END AS totals_visits,
         CASE WHEN s.n = 1 THEN CAST(1 AS BIGINT) END AS totals_bounces,
         CAST(s.n AS BIGINT) AS totals_hits,
         CAST(s.views AS BIGINT) AS totals_pageviews,
         CASE WHEN s.n > 1 THEN (s.us1 - s.us0) // 1000000 END AS totals_timeOnSite,
         CASE WHEN s.purchases > 0 THEN CAST(s.purchases AS BIGINT) END AS totals_transactions,
         CAST(s.rev AS BIGINT) AS totals_transactionRevenue,
         CAST(s.rev + s.purchases * 5000000 AS BIGINT) AS totals_totalTransactionRevenue,
         CASE WHEN s.user_id % 13 <> 0 THEN 'src' || CAST(s.user_id % 7 AS VARCHAR) END
           AS trafficSource_source,
         CASE s.user_id % 4 WHEN 0 THEN 'organic' WHEN 1 THEN 'cpc' WHEN 2 THEN 'referral'
                            ELSE 'email' END AS trafficSource_medium,
         CASE s.user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END
           AS device_deviceCategory,
         s.user_id % 3 = 1 AS device_isMobile,
         n.n_name AS geoNetwork_country,
         r.r_name AS geoNetwork_continent,
         CAST(s.n AS BIGINT) AS n_hits,
         CAST(s.user_id % 3 AS BIGINT) AS n_custom_dimensions
  FROM sess s
  LEFT JOIN nation n ON s.user_id % 25 = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
r3 AS (SELECT CAST(range AS BIGINT) AS i FROM range(0, 3))
"""


def _with(body: str) -> str:
    return "WITH " + _EV.strip() + "\n" + body


def _cut(col: str = "date") -> str:
    return f"{col} <= DATE '{CUTOFF}'"


SESSION_KEY = "(fullVisitorId || CAST(visitId AS VARCHAR))"


def _oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    q["bounce_rate_per_source"] = _with(f"""
SELECT source, total_visits, total_no_of_bounces,
       {half_up('total_no_of_bounces', 'total_visits', 2, 100)} AS bounce_rate
FROM (SELECT trafficSource_source AS source,
             COUNT(totals_visits) AS total_visits,
             CAST(COALESCE(SUM(totals_bounces), 0) AS BIGINT) AS total_no_of_bounces
      FROM compact WHERE {_cut()} GROUP BY 1) t""")

    q["country_sessions"] = _with(f"""
SELECT country, sessions, total_bounces,
       {half_up('total_bounces', 'sessions', 3)} AS bounce_rate,
       {half_up('time_on_site', 'sessions', 2)} AS average_session_duration_secs
FROM (SELECT geoNetwork_country AS country,
             COUNT(DISTINCT {SESSION_KEY}) AS sessions,
             CAST(SUM(CASE WHEN totals_bounces = 1 THEN totals_visits ELSE 0 END) AS BIGINT)
               AS total_bounces,
             SUM(totals_timeOnSite) AS time_on_site
      FROM compact WHERE {_cut()} AND totals_visits = 1 GROUP BY 1) t""")

    q["traffic_conversion"] = _with(f"""
SELECT medium, sessions, transactions,
       {half_up('revenue_micros', '1000000', 3)} AS total_revenue,
       {half_up('bounces', 'sessions', 3)} AS bounce_rate,
       {half_up('transactions', 'sessions', 3)} AS conversion_rate
FROM (SELECT trafficSource_medium AS medium,
             COUNT(DISTINCT {SESSION_KEY}) AS sessions,
             CAST(SUM(totals_transactions) AS BIGINT) AS transactions,
             SUM(totals_totalTransactionRevenue) AS revenue_micros,
             SUM(totals_bounces) AS bounces
      FROM compact WHERE {_cut()} AND totals_visits = 1 GROUP BY 1) t""")

    q["metrics_per_quarter"] = _with(f"""
SELECT year, quarter, users, visits, pageviews, bounces, transactions,
       {half_up('revenue_micros', '1000000', 2)} AS revenue,
       {half_up('total_revenue_micros', 'visits * 1000000', 2)} AS revenue_per_visit
FROM (SELECT CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
             COUNT(DISTINCT fullVisitorId) AS users,
             CAST(SUM(totals_visits) AS BIGINT) AS visits,
             CAST(SUM(totals_pageviews) AS BIGINT) AS pageviews,
             CAST(SUM(totals_bounces) AS BIGINT) AS bounces,
             CAST(SUM(totals_transactions) AS BIGINT) AS transactions,
             SUM(totals_transactionRevenue) AS revenue_micros,
             SUM(totals_totalTransactionRevenue) AS total_revenue_micros
      FROM compact WHERE {_cut()} AND totals_visits = 1 GROUP BY 1, 2) t""")

    labels = ("WHEN '1' THEN 'Click through of product lists' WHEN '2' THEN 'Product detail views' "
              "WHEN '5' THEN 'Check out' WHEN '6' THEN 'Completed purchase' WHEN '7' THEN 'Refund of purchase'")
    excluded = "'0', '3', '4'"
    q["conversion_path"] = _with(f"""
, stages AS (
  SELECT CASE action {labels} END AS user_action, CAST(SUM(n_products) AS BIGINT) AS users
  FROM hit WHERE {_cut('day')} AND action NOT IN ({excluded}) AND n_products > 0
  GROUP BY 1),
lagged AS (
  SELECT user_action, users,
         LAG(users, 1) OVER (ORDER BY users DESC, user_action ASC NULLS LAST) AS prev_users
  FROM stages)
SELECT user_action, users,
       COALESCE({half_up('users', 'prev_users', 2, 100)}, 100.0)
         AS conversion_percent_rate_from_previous_stage
FROM lagged""")

    q["promotion_ctr"] = _with(f"""
, promo AS (
  SELECT 'promo' || CAST((h.k + r3.i) % 5 AS VARCHAR) AS promotion_name,
         'c' || CAST(h.k % 2 AS VARCHAR) AS promotion_type,
         'pos' || CAST(r3.i AS VARCHAR) AS promotion_position,
         h.event_type IN ('view', 'error', 'signup') AS viewed,
         h.event_type = 'click' AS clicked
  FROM hit h JOIN r3 ON r3.i < h.n_promotions
  WHERE {_cut('h.day')}),
agg AS (
  SELECT promotion_name, promotion_type, promotion_position,
         COUNT(*) FILTER (WHERE viewed) AS promotion_views,
         COUNT(*) FILTER (WHERE clicked) AS promotion_clicks
  FROM promo GROUP BY 1, 2, 3)
SELECT *, {half_up('promotion_clicks', 'promotion_views', 2, 100)} AS promotion_click_through_rate
FROM agg WHERE promotion_views > promotion_clicks""")

    def pages(title: str) -> str:
        return _with(f"""
SELECT page, CAST(SUM(u) AS BIGINT) AS unique_pageviews
FROM (SELECT '/p' || CAST(k % 12 AS VARCHAR) AS page, {title} AS page_concat,
             COUNT(DISTINCT {SESSION_KEY}) AS u
      FROM hit WHERE {_cut('day')} GROUP BY 1, 2) t
GROUP BY page""")

    q["unique_page_views"] = pages("CAST(NULL AS VARCHAR)")
    q["unique_page_views_titled"] = pages(
        "'/p' || CAST(k % 12 AS VARCHAR) || 'T' || CAST(k % 5 AS VARCHAR)")

    q["ordered_report"] = _with(f"""
SELECT CAST(row_number() OVER (ORDER BY sessions DESC, medium ASC NULLS LAST) AS INTEGER) AS pos,
       medium, sessions
FROM (SELECT trafficSource_medium AS medium, COUNT(DISTINCT {SESSION_KEY}) AS sessions
      FROM compact WHERE {_cut()} AND totals_visits = 1 GROUP BY 1) t""")

    q["raw_scan"] = _with("""
SELECT fullVisitorId, visitId, strftime(date, '%Y%m%d') AS date_text, n_hits, TRUE AS gzip_file
FROM compact""")

    q["file_ledger"] = _with("""
SELECT folder, state, COUNT(*) AS rows, CAST(SUM(bad) AS BIGINT) AS bad_rows, COUNT(*) AS in_table FROM (
  SELECT CASE WHEN dayofmonth(date) <= 10 THEN 'early' ELSE 'late' END AS folder, 'loaded' AS state, 0 AS bad FROM compact
  UNION ALL SELECT 'cut', 'loaded', 1 FROM compact WHERE CAST(fullVisitorId AS BIGINT) % 5 = 0
  UNION ALL SELECT 'compact', 'merged', 0 FROM compact) t
GROUP BY 1, 2""")

    q["path_extract"] = _with("""
SELECT fullVisitorId, visitId, trafficSource_medium, trafficSource_source, device_deviceCategory,
       device_isMobile, geoNetwork_country, geoNetwork_continent, n_hits, n_custom_dimensions
FROM compact""")

    q["cast_strict"] = _with("""
SELECT fullVisitorId, visitId, visitNumber, visitStartTime, totals_visits, totals_bounces,
       totals_hits, totals_pageviews, totals_timeOnSite, totals_transactions,
       totals_transactionRevenue, totals_totalTransactionRevenue
FROM compact""")

    q["date_parse"] = _with("SELECT date, COUNT(*) AS sessions FROM compact GROUP BY date")

    q["date_cutoff"] = _with(f"""
SELECT date, COUNT(*) AS sessions, CAST(SUM(totals_hits) AS BIGINT) AS hits
FROM compact WHERE {_cut()} GROUP BY date""")

    q["sessions_distinct"] = _with(f"""
SELECT date, COUNT(DISTINCT {SESSION_KEY}) AS sessions, COUNT(DISTINCT fullVisitorId) AS visitors
FROM compact GROUP BY date""")

    q["content_dedupe"] = _with("""
SELECT date, 2 * COUNT(*) AS documents, COUNT(*) AS distinct_hashes, COUNT(*) AS deduped_rows
FROM compact GROUP BY date""")

    q["required_key_check"] = _with("""
SELECT CASE WHEN CAST(fullVisitorId AS BIGINT) % 17 = 0 OR CAST(fullVisitorId AS BIGINT) % 19 = 0
            THEN 'rejected' ELSE 'valid' END AS status,
       COUNT(*) AS sessions
FROM compact GROUP BY 1""")

    q["not_in_filter"] = _with(f"""
SELECT action AS action_type, COUNT(*) AS hits
FROM hit WHERE {_cut('day')} AND action NOT IN ({excluded}) GROUP BY 1""")

    q["flatten_inner"] = _with("""
SELECT fullVisitorId, visitId, CAST(SUM(n_products) AS BIGINT) AS rows
FROM hit GROUP BY 1, 2 HAVING SUM(n_products) > 0""")

    q["flatten_outer"] = _with("""
SELECT fullVisitorId, visitId, CAST(SUM(greatest(n_products, 1)) AS BIGINT) AS rows
FROM hit GROUP BY 1, 2""")

    q["flatten_nested"] = _with("""
SELECT h.fullVisitorId, h.visitId, 'pd' || CAST(h.k + p.i AS VARCHAR) AS value, COUNT(*) AS rows
FROM hit h JOIN r3 p ON p.i < h.n_products
WHERE (h.k + p.i) % 2 = 1
GROUP BY 1, 2, 3""")

    # Rows per hit: promotions x m(session dims) x m(experiments) x m(hit dims)
    # x sum over products of m(product dims) * m(product metrics), m(n) = max(1, n),
    # and the product sum is 1 for a hit without products.
    q["flatten_fanout"] = _with("""
, per_product AS (
  SELECT h.event_id, SUM(greatest((h.k + p.i) % 2, 1) * greatest((h.k + p.i) % 3, 1)) AS m
  FROM hit h JOIN r3 p ON p.i < h.n_products GROUP BY h.event_id)
SELECT h.fullVisitorId, h.visitId,
       CAST(SUM(h.n_promotions * greatest(h.user_id % 3, 1) * greatest(h.n_experiments, 1)
                * greatest(h.n_hit_dims, 1) * COALESCE(pp.m, 1)) AS BIGINT) AS rows
FROM hit h LEFT JOIN per_product pp ON pp.event_id = h.event_id
WHERE h.n_promotions > 0
GROUP BY 1, 2""")

    q["exploded_refresh"] = _with("""
SELECT h.fullVisitorId, h.visitId, h.day AS date,
       CASE WHEN h.user_id % 11 <> 0 THEN CAST(1 AS BIGINT) END AS totals_visits,
       h.hit_number AS hits_hitNumber,
       h.action AS hits_eCommerceAction_action_type,
       'promo' || CAST((h.k + pr.i) % 5 AS VARCHAR) AS hits_promotion_promoName,
       CAST(h.k + pd.i AS VARCHAR) AS hits_product_productSKU,
       sd.i + 1 AS customDimensions_index,
       CASE WHEN sd.i IS NOT NULL THEN 'cd' || CAST((h.user_id + sd.i) % 4 AS VARCHAR) END
         AS customDimensions_value,
       CASE WHEN ex.i IS NOT NULL THEN 'exp' || CAST(h.k % 7 AS VARCHAR) END
         AS hits_experiment_experimentId,
       CASE WHEN hd.i IS NOT NULL THEN 'hd' || CAST(h.k % 4 AS VARCHAR) END
         AS hits_customDimensions_value,
       CASE WHEN pcd.i IS NOT NULL THEN 'pd' || CAST(h.k + pd.i AS VARCHAR) END
         AS hits_product_customDimensions_value
FROM hit h
JOIN r3 pr ON pr.i < h.n_promotions
LEFT JOIN r3 pd ON pd.i < h.n_products
LEFT JOIN r3 sd ON sd.i < h.user_id % 3
LEFT JOIN r3 ex ON ex.i < h.n_experiments
LEFT JOIN r3 hd ON hd.i < h.n_hit_dims
LEFT JOIN r3 pcd ON pd.i IS NOT NULL AND pcd.i < (h.k + pd.i) % 2
LEFT JOIN r3 pcm ON pd.i IS NOT NULL AND pcm.i < (h.k + pd.i) % 3""")

    q["clustered_scan"] = _with("""
SELECT fullVisitorId, visitId, date, totals_hits
FROM compact WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")

    q["cast_lenient"] = _with("""
SELECT fullVisitorId, visitId,
       CASE WHEN CAST(fullVisitorId AS BIGINT) % 7 = 0 THEN NULL ELSE visitNumber END AS visitNumber,
       CASE WHEN CAST(fullVisitorId AS BIGINT) % 9 = 0 THEN NULL ELSE date END AS date
FROM compact""")

    q["conversion_path_distinct_users"] = _with(f"""
, stages AS (
  SELECT CASE action {labels} END AS user_action, COUNT(DISTINCT fullVisitorId) AS users
  FROM hit WHERE {_cut('day')} AND action NOT IN ({excluded}) AND n_products > 0
  GROUP BY 1),
lagged AS (
  SELECT user_action, users,
         LAG(users, 1) OVER (ORDER BY users DESC, user_action ASC NULLS LAST) AS prev_users
  FROM stages)
SELECT user_action, users,
       COALESCE({half_up('users', 'prev_users', 2, 100)}, 100.0)
         AS conversion_percent_rate_from_previous_stage
FROM lagged""")

    q["country_sessions_exact_key"] = q["country_sessions"].replace(
        f"COUNT(DISTINCT {SESSION_KEY})", "COUNT(DISTINCT (fullVisitorId, visitId))")

    q["exploded_outer_promotions"] = _with("""
, per_product AS (
  SELECT h.event_id, SUM(greatest((h.k + p.i) % 2, 1)) AS m
  FROM hit h JOIN r3 p ON p.i < h.n_products GROUP BY h.event_id)
SELECT h.fullVisitorId, h.visitId,
       CAST(SUM(greatest(h.n_promotions, 1) * greatest(h.user_id % 3, 1)
                * greatest(h.n_experiments, 1) * greatest(h.n_hit_dims, 1)
                * COALESCE(pp.m, 1)) AS BIGINT) AS rows
FROM hit h LEFT JOIN per_product pp ON pp.event_id = h.event_id
GROUP BY 1, 2""")

    by_date = f"SELECT date, COUNT(*) AS rows, COUNT(DISTINCT {SESSION_KEY}) AS sessions FROM compact GROUP BY date"
    for name in ("upsert_first_load", "upsert_insert_only", "upsert_idempotent", "upsert_late_documents", "streaming_ingest"):
        q[name] = _with(by_date)
    q["pipeline_two_runs"] = q["flatten_fanout"]
    q["exploded_after_replace"] = q["flatten_fanout"].replace(
        "WHERE h.n_promotions > 0",
        "WHERE h.n_promotions > 0 AND h.user_id % 4 <> 0 AND h.day <> DATE '2024-01-05'")

    q["upsert_moves_partitions"] = """
SELECT o_orderkey, o_totalprice,
       CASE WHEN month(o_orderdate) = 2 THEN 'all of February / x=y' WHEN o_orderkey % 10 = 0 THEN '2030:01'
            ELSE strftime(o_orderdate, '%Y:%m') END AS period
FROM orders"""
    q["upsert_null_keys"] = """
SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS key, o_orderkey,
       COUNT(*) * CASE WHEN o_orderkey % 5 <> 0 THEN 1 ELSE 2 END AS rows
FROM orders GROUP BY 1, 2"""
    q["signed_ratio"] = f"""
SELECT o_custkey, {half_up('net', 'orders * 8', 0)} AS whole, {half_up('net', '-orders * 8', 2)} AS turned
FROM (SELECT o_custkey, COUNT(*) AS orders,
             SUM(CASE WHEN o_orderkey % 3 = 0 THEN -4 ELSE 1 END * CAST(round(o_totalprice * 100) AS BIGINT)) AS net
      FROM orders GROUP BY 1) t"""

    # Report columns in the order in which the views return them; D: a ratio.
    shown = {"bounce_rate_per_source": "source, total_visits, total_no_of_bounces, D bounce_rate",
             "country_sessions": "country, sessions, total_bounces, D bounce_rate, D average_session_duration_secs",
             "traffic_conversion": "medium, sessions, transactions, D total_revenue, D bounce_rate, D conversion_rate",
             "metrics_per_quarter": "year, quarter, users, visits, pageviews, bounces, transactions, D revenue, D revenue_per_visit",
             "conversion_path": "user_action, users, D conversion_percent_rate_from_previous_stage",
             "promotion_ctr": "promotion_name, promotion_type, promotion_position, promotion_views, promotion_clicks, "
                              "D promotion_click_through_rate",
             "unique_page_views": "page, unique_pageviews"}
    asked = []
    for name, columns in shown.items():
        text = [f"COALESCE(CAST(CAST({c[2:]} AS DECIMAL(30,4)) AS VARCHAR), '~')" if c.startswith("D ") else f"COALESCE(CAST({c} AS VARCHAR), '~')"
                for c in columns.split(", ")]
        sql = q[name].replace("\n  FROM ev\n)", "\n  FROM ev WHERE user_id % 4 <> 0\n)") if name in (
            "conversion_path", "promotion_ctr", "unique_page_views") else q[name]  # these sessions have lost their hits
        asked.append(f"SELECT '{name}' AS report, {' || chr(124) || '.join(text)} AS row FROM ({sql})")
    q["views_follow_table"] = " UNION ALL ".join(asked)
    q["report_tables_current"] = q["views_follow_table"]  # tables and views hold the same
    times = "h.n_promotions * greatest(h.user_id % 3, 1) * greatest(h.n_experiments, 1)\n                * greatest(h.n_hit_dims, 1) * COALESCE(pp.m, 1)"
    q["exploded_hot_sessions"] = q["flatten_fanout"].replace(
        f"CAST(SUM({times}) AS BIGINT) AS rows", f"CAST(SUM({times}) AS BIGINT) AS rows, CAST(SUM(h.hit_number * {times}) AS BIGINT) AS hit_numbers")
    q["exploded_other_options"] = q["exploded_outer_promotions"]
    q["ordered_ascending"] = f"""
SELECT CAST(row_number() OVER (ORDER BY country ASC NULLS LAST) AS INTEGER) AS pos, country, sessions FROM ({q["country_sessions"]}) t"""
    quarters = q["metrics_per_quarter"].replace("CAST(s.user_id AS VARCHAR) AS fullVisitorId", "CAST(s.user_id AS VARCHAR) AS fullVisitorId, s.user_id AS u") \
        .replace("FROM compact", "FROM (SELECT * REPLACE (CAST(date + to_months(CAST(u % 9 AS INTEGER)) AS DATE) AS date) FROM compact) AS compact") \
        .replace(f"DATE '{CUTOFF}'", "DATE '2024-10-01'")
    q["ordered_two_columns"] = f"""
SELECT CAST(row_number() OVER (ORDER BY year DESC, quarter DESC) AS INTEGER) AS pos, year, quarter, users, visits FROM ({quarters}) t"""
    # Every test day is long past: a report of today sees all of them.
    q["report_of_today"] = q["traffic_conversion"].replace(f"DATE '{CUTOFF}'", "current_date - 30")
    q["all_columns"] = _all_columns()
    q["upsert_update"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year
FROM orders
UNION  -- the batch collapses equal keys: order 0 and its negation are one row
SELECT -o_orderkey, 'X', o_totalprice, CAST(year(o_orderdate) AS INTEGER)
FROM orders WHERE o_orderkey % 10 = 0"""
    for name in ("bounce_rate_per_source", "country_sessions", "traffic_conversion",
                 "metrics_per_quarter", "conversion_path", "promotion_ctr", "unique_page_views"):
        q[f"sql_{name}"] = q[name]          # the published view answers the same question
    for name in ("conversion_path", "promotion_ctr", "unique_page_views"):
        q[f"hits_{name}"] = q[name]         # so do the reports over the per-hit table
    return q


ORACLE_SQL: dict[str, str] = _oracles()
