"""The seven reports as tables that are kept current from partial results per date.

A *partial* of a report holds, for every date, what the report needs of that date's
sessions and nothing else: sums and counts per report key where these are enough, and
otherwise one row per key and distinct member (session or visitor) with its sums.
Partials of different dates merge: sums add up, and a member that occurs on several
dates is counted once, so distinct counts are exact, not estimated.

Each partial is a table derived from the compact or the per-hit table (see
``refresh_derived``): its pointer notes which generations of every date it was built
from, so after an upsert only the dates that changed are read again, whoever changed
them, and only their hits are taken out of the blobs (once, into the per-hit table).
The cutoff is a filter on the partials' dates, so the same partials serve every day.

A report table is one more table with a pointer: readers see the report before or
after a refresh, never half of it, and a refresh that would change nothing (same partial,
same cutoff) writes nothing.

Work: a refresh reads the changed dates of the compact table and, for reports whose
partial or cutoff changed, the narrow partials of the dates before the cutoff.  Sums
combine map-side; the distinct counts shuffle by (key, member) first, so a key that holds
a third of all sessions is spread over many tasks.
"""

from __future__ import annotations

import datetime
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.functions import metrics, variant
from hitloom.functions.metrics import date_cutoff, session_key
from hitloom.operators import flatten, snapshots
from hitloom.operators.snapshots import Conflict
from hitloom.operators.upsert import PARTITION_COLUMN, TRIES, table_schema
from hitloom.plans import hit_reports, reports
from hitloom.plans.pipeline import build_signature, refresh_derived
from hitloom.plans.reports import EXCLUDED_ACTIONS, VIEW_NAMES
from hitloom.session import set_session_defaults

DAYS = 30


@dataclass(frozen=True)
class Partial:
    """How one report is taken apart: ``build`` gives the rows of each date (with the column ``date``),
    ``merge`` the report from such rows of any dates.  ``of_hits``: built from the per-hit table."""

    build: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    of_hits: bool = False


def _sums(**columns: str) -> list:
    return [F.sum(c).alias(name) for name, c in columns.items()]


def _again(*columns: str) -> list:
    return _sums(**{c: c for c in columns})


def _single(compact: DataFrame) -> DataFrame:
    return compact.filter(F.col("totals_visits") == 1)


def _bounces(compact: DataFrame) -> DataFrame:
    return (compact.groupBy("date", F.col("trafficSource_source").alias("source"))
            .agg(F.count("totals_visits").alias("total_visits"), F.sum("totals_bounces").alias("bounces")))


def _merge_bounces(rows: DataFrame) -> DataFrame:
    return reports.bounce_rates(rows.groupBy("source").agg(
        F.sum("total_visits").alias("total_visits"), F.coalesce(F.sum("bounces"), F.lit(0)).alias("total_no_of_bounces")))


def _countries(compact: DataFrame) -> DataFrame:
    bounce = F.when(F.col("totals_bounces") == 1, F.col("totals_visits")).otherwise(F.lit(0))
    return (_single(compact).groupBy("date", F.col("geoNetwork_country").alias("country"), session_key().alias("session"))
            .agg(F.sum(bounce).alias("total_bounces"), F.sum("totals_timeOnSite").alias("time_on_site")))


def _merge_countries(rows: DataFrame) -> DataFrame:
    return reports.country_rates(rows.groupBy("country").agg(
        F.countDistinct("session").alias("sessions"), *_again("total_bounces", "time_on_site")))


def _media(compact: DataFrame) -> DataFrame:
    return (_single(compact).groupBy("date", F.col("trafficSource_medium").alias("medium"), session_key().alias("session"))
            .agg(*_sums(transactions="totals_transactions", revenue_micros="totals_totalTransactionRevenue", bounces="totals_bounces")))


def _merge_media(rows: DataFrame) -> DataFrame:
    return reports.medium_rates(rows.groupBy("medium").agg(
        F.countDistinct("session").alias("sessions"), *_again("transactions", "revenue_micros", "bounces")))


_QUARTER = {"visits": "totals_visits", "pageviews": "totals_pageviews", "bounces": "totals_bounces",
            "transactions": "totals_transactions", "revenue_micros": "totals_transactionRevenue",
            "total_revenue_micros": "totals_totalTransactionRevenue"}


def _visitors(compact: DataFrame) -> DataFrame:
    return _single(compact).groupBy("date", "fullVisitorId").agg(*_sums(**_QUARTER))


def _merge_visitors(rows: DataFrame) -> DataFrame:
    return reports.quarter_rates(rows.groupBy(F.year("date").alias("year"), F.quarter("date").alias("quarter")).agg(
        F.countDistinct("fullVisitorId").alias("users"), *_again(*_QUARTER)))


def _stages(hits: DataFrame) -> DataFrame:
    rows = hits.filter(~F.col("action").isin(*EXCLUDED_ACTIONS) & (F.col("n_products") > 0) & F.col("fullVisitorId").isNotNull())
    return rows.groupBy("date", reports.stage_label("action")).agg(F.sum("n_products").cast("bigint").alias("users"))


def _merge_stages(rows: DataFrame) -> DataFrame:
    return reports.funnel(rows.groupBy("user_action").agg(*_again("users")))


_PROMOTION = ("promotion_name", "promotion_type", "promotion_position")


def _promotions(hits: DataFrame) -> DataFrame:
    rows = hits.select("date", "viewed", "clicked", F.explode("promotions").alias("p")).select(
        "date", F.col("p.name").alias("promotion_name"), F.col("p.creative").alias("promotion_type"),
        F.col("p.position").alias("promotion_position"), "viewed", "clicked")
    return rows.groupBy("date", *_PROMOTION).agg(
        F.count_if("viewed").alias("promotion_views"), F.count_if("clicked").alias("promotion_clicks"))


def _merge_promotions(rows: DataFrame) -> DataFrame:
    return reports.click_rates(rows.groupBy(*_PROMOTION).agg(*_again("promotion_views", "promotion_clicks")))


def _pages(hits: DataFrame) -> DataFrame:
    return hits.select("date", F.col("page_path").alias("page"), F.col("page_title_lower").alias("title"),
                       session_key().alias("session")).distinct()


PARTIALS = {
    "bounce_rate_per_source": Partial(_bounces, _merge_bounces),
    "country_sessions": Partial(_countries, _merge_countries),
    "traffic_conversion": Partial(_media, _merge_media),
    "metrics_per_quarter": Partial(_visitors, _merge_visitors),
    "conversion_path": Partial(_stages, _merge_stages, of_hits=True),
    "promotion_ctr": Partial(_promotions, _merge_promotions, of_hits=True),
    "unique_page_views": Partial(_pages, reports.page_views, of_hits=True),
}


@dataclass
class ReportTables:
    # Report -> path of its table (read it with ``snapshots.read``).
    paths: dict[str, str]
    # Report -> dates of its partial that were built anew (None: all).
    rebuilt: dict[str, list[str] | None] = field(default_factory=dict)
    # Reports whose table was written.
    written: list[str] = field(default_factory=list)


def _signature() -> str:
    return build_signature([variant, metrics, flatten, hit_reports, reports, sys.modules[__name__]])


def _publish_report(spark: SparkSession, partial: str, path: str, merge: Callable[[DataFrame], DataFrame], signature: str,
                    as_of: str, days: int) -> bool:
    """Bring the report table at ``path`` to the partial's state and the cutoff; tells whether it wrote."""
    for attempt in range(TRIES):
        source = snapshots.state(spark, partial)
        mine = snapshots.state(spark, path)
        limit = str(datetime.date.fromisoformat(as_of) - datetime.timedelta(days=days))
        # Dates beyond the cutoff are no part of the report: a change there leaves its table alone.
        used = {p: list(g) for p, g in source.parts.items() if (snapshots.part_value(p) or "~") <= limit}
        built = {"signature": signature, "limit": limit, "source": used}
        # A later cutoff over the same dates gives the same report.
        if mine and {**mine.note["built"], "limit": limit} == built:
            return False
        gen = snapshots.new_generation(mine)
        report = merge(snapshots.read(spark, partial, at=source).filter(date_cutoff(as_of, days)))
        report.write.mode("overwrite").parquet(snapshots.generation_path(path, gen))
        try:
            snapshots.publish(spark, path, mine, {"": (gen,)}, {"schema": table_schema(report, None), "built": built})
            return True
        except Conflict:
            fs.delete(spark, snapshots.generation_path(path, gen))
            if attempt == TRIES - 1:
                raise
    raise AssertionError("unreachable")


def refresh_report_tables(spark: SparkSession, compact_path: str, out_dir: str, as_of: str | datetime.date | None = None, days: int = DAYS,
                          names: dict[str, str] | None = None, hits_path: str | None = None, full: bool = False) -> ReportTables:
    """Bring the seven report tables below ``out_dir`` up to the compact table as it is now.

    The partials lie in ``<out_dir>/partials``, the per-hit table in ``hits_path`` (there too unless it is given); the tables get
    the names of the views, or ``names``.  Without ``as_of`` the cutoff is today's.  ``full`` builds every partial anew."""
    unknown = set(names or {}) - set(PARTIALS)
    if unknown:
        raise ValueError(f"no such report: {', '.join(sorted(unknown))}")
    set_session_defaults(spark)
    as_of = str(as_of or spark.sql("SELECT current_date()").first()[0])
    signature = _signature()
    hits_path = hits_path or f"{out_dir}/partials/hits"
    hit_reports.refresh_hits(spark, compact_path, hits_path, full)
    out = ReportTables({r: f"{out_dir}/{ {**VIEW_NAMES, **(names or {})}[r]}" for r in PARTIALS})
    for report, how in PARTIALS.items():
        partial = f"{out_dir}/partials/{report}"
        # A date's rows come from many tasks after the grouping: gathered, a date is as few files as it fills.
        out.rebuilt[report] = refresh_derived(spark, hits_path if how.of_hits else compact_path, partial,
                                              lambda rows, build=how.build: build(rows).hint("rebalance", PARTITION_COLUMN), full, signature)
        if _publish_report(spark, partial, out.paths[report], how.merge, signature, as_of, days):
            out.written.append(report)
    return out
