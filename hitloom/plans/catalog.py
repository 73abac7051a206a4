"""Query catalogue for the driver: Spark queries and their SQL oracles.

Spark side: events -> session documents (gzip JSON files) -> raw variant ->
compact table (upsert) -> operator or report.  Oracle side: the same numbers
straight from the flat ``events``/``nation``/``region``/``orders`` tables in
plain SQL, with no JSON involved -- two independent routes to each result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs, spec
from hitloom.functions.metrics import date_cutoff, ratio, session_key
from hitloom.functions.variant import content_hash, vget, vtext
from hitloom.operators import snapshots
from hitloom.operators.compact import required_key_check, to_compact
from hitloom.operators.explode import explode_sessions
from hitloom.operators.flatten import flatten
from hitloom.operators.order import numbered
from hitloom.operators.upsert import stage, upsert
from hitloom.plans import reports, views
from hitloom.plans.pipeline import load_compact_batch, refresh_exploded, run_pipeline, stage_for
from hitloom.plans.report_tables import refresh_report_tables
from hitloom.session import set_session_defaults, work_dir
from hitloom.sources import ledger
from hitloom.sources.fixtures import session_docs_for
from hitloom.sources.full_docs import full_docs
from hitloom.sources.raw import load_raw, raw_from_text, write_json_files
from hitloom.sources.tables import spread, table

AS_OF = "2024-02-20"          # fixed report date: cutoff 2024-01-21
SPLIT_DAY = (15, 10)          # upsert fixture: first batch days <= 15, second >= 10

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ helpers

def _compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    set_session_defaults(spark)
    return snapshots.read(spark, stage_for(spark, sf_dir).compact)


def _landing(spark: SparkSession, sf_dir: str) -> str:
    set_session_defaults(spark)
    return stage_for(spark, sf_dir, compact=False).landing


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracted landing files, for queries that merge from them more than once: documents are parsed, hashed and cast once."""
    return _staged(load_compact_batch(spark, _landing(spark, sf_dir)), "extracted")


def _run_dir(spark: SparkSession, name: str) -> str:
    path = f"{work_dir(spark)}/runs/{name}-{uuid.uuid4().hex}"
    fs.delete_at_end(spark, path)
    return path


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, for queries that read it more than once."""
    created: list[str] = []
    out = stage(df, name, created)
    for path in created:
        fs.delete_at_end(df.sparkSession, path)
    return out


# ------------------------------------------------------------------ reports

def _report(name: str, **kw) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return reports.REPORTS[name](_compact(spark, sf_dir), AS_OF, **kw)
    q.__name__ = name
    return q


def q_unique_page_views_titled(spark, sf_dir):
    return reports.unique_page_views(_compact(spark, sf_dir), AS_OF, title_key="pageTitle")


def _sql(name: str) -> Query:
    """The published view, asked through SQL."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = views.publish_views(spark, stage_for(spark, sf_dir).compact, AS_OF)
        return spark.sql(f"SELECT * FROM {names[name]}")
    q.__name__ = f"sql_{name}"
    return q


def _from_hits(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from hitloom.plans.hit_reports import HIT_REPORTS
        hits = snapshots.read(spark, stage_for(spark, sf_dir, hits=True).hits)
        return HIT_REPORTS[name](hits, AS_OF)
    q.__name__ = f"hits_{name}"
    return q


def q_ordered_report(spark, sf_dir):
    """Report order made visible: ``pos`` is the row's place in the report's
    ORDER BY (the aggregated result has one row per medium)."""
    r = reports.traffic_conversion(_compact(spark, sf_dir), AS_OF)
    placed = numbered(r, F.desc_nulls_first("sessions"), F.asc_nulls_last("medium"))
    return placed.select(F.col("pos").cast("int").alias("pos"), "medium", "sessions")


def q_ordered_ascending(spark, sf_dir):
    """SRT-2: countries ascending; the report gives each country one row."""
    r = reports.country_sessions(_compact(spark, sf_dir), AS_OF)
    return numbered(r, F.asc_nulls_last("country")).select(F.col("pos").cast("int").alias("pos"), "country", "sessions")


def q_ordered_two_columns(spark, sf_dir):
    """SRT-3: year and quarter descending, over days spread across three quarters by visitor."""
    spread = _compact(spark, sf_dir).withColumn("date", F.add_months("date", F.col("fullVisitorId").cast("int") % 9))
    r = reports.metrics_per_quarter(spread, "2024-10-31")
    placed = numbered(r, F.desc_nulls_first("year"), F.desc_nulls_first("quarter"))
    return placed.select(F.col("pos").cast("int").alias("pos"), "year", "quarter", "users", "visits")


def q_report_of_today(spark, sf_dir):
    """FN-7: the cutoff of a report without ``as_of`` is today's."""
    return reports.traffic_conversion(_compact(spark, sf_dir))


# ------------------------------------------------------------------ sources & projections

def q_raw_scan(spark, sf_dir):
    """Gzip JSON files listed and read into one variant column."""
    raw = load_raw(spark, _landing(spark, sf_dir), with_source=True)
    hits = F.variant_get("raw_text", "$.hits", "array<variant>")
    return raw.select(
        vget("raw_text", "$.fullVisitorId", "string").alias("fullVisitorId"),
        vget("raw_text", "$.visitId", "bigint").alias("visitId"),
        vget("raw_text", "$.date", "string").alias("date_text"),
        F.size(hits).cast("bigint").alias("n_hits"),
        F.col("source_file").endswith(".gz").alias("gzip_file"))


def q_path_extract(spark, sf_dir):
    c = _compact(spark, sf_dir)
    return c.select("fullVisitorId", "visitId", "trafficSource_medium", "trafficSource_source",
                    "device_deviceCategory", "device_isMobile", "geoNetwork_country",
                    "geoNetwork_continent",
                    F.size(F.variant_get("hits", "$", "array<variant>")).cast("bigint").alias("n_hits"),
                    F.size(F.variant_get("customDimensions", "$", "array<variant>")).cast("bigint")
                    .alias("n_custom_dimensions"))


def q_cast_strict(spark, sf_dir):
    c = _compact(spark, sf_dir)
    return c.select("fullVisitorId", "visitId", "visitNumber", "visitStartTime", "totals_visits",
                    "totals_bounces", "totals_hits", "totals_pageviews", "totals_timeOnSite",
                    "totals_transactions", "totals_transactionRevenue",
                    "totals_totalTransactionRevenue")


def q_date_parse(spark, sf_dir):
    c = _compact(spark, sf_dir)
    return c.groupBy("date").agg(F.count(F.lit(1)).alias("sessions"))


def q_date_cutoff(spark, sf_dir):
    c = _compact(spark, sf_dir).filter(date_cutoff(AS_OF))
    return c.groupBy("date").agg(F.count(F.lit(1)).alias("sessions"),
                                 F.sum("totals_hits").alias("hits"))


def q_sessions_distinct(spark, sf_dir):
    c = _compact(spark, sf_dir)
    return c.groupBy("date").agg(F.countDistinct(session_key()).alias("sessions"),
                                 F.countDistinct("fullVisitorId").alias("visitors"))


def q_content_dedupe(spark, sf_dir):
    """Every document twice, once with its first two keys swapped: the hash
    ignores key order, so deduplication on (visit, visitor, hash) restores
    one row per session."""
    docs = session_docs_for(spark, sf_dir).select("doc")
    swapped = F.regexp_replace("doc", r'^\{("clientId":"[^"]*"),("fullVisitorId":"[^"]*"),', r"{$2,$1,")
    raw = raw_from_text(docs.select(F.explode(F.array("doc", swapped)).alias("doc")))
    rows = raw.select(vget("raw_text", "$.fullVisitorId", "string").alias("fullVisitorId"),
                      vget("raw_text", "$.visitId", "bigint").alias("visitId"),
                      vget("raw_text", "$.date", "date").alias("date"),
                      content_hash("raw_text").alias("hash_id"))
    rows = _staged(rows, "hashed")   # two aggregates read them
    per_date = rows.groupBy("date").agg(
        F.count(F.lit(1)).alias("documents"),
        F.countDistinct("hash_id").alias("distinct_hashes"))
    deduped = (rows.dropDuplicates(["visitId", "fullVisitorId", "hash_id"])
               .groupBy("date").agg(F.count(F.lit(1)).alias("deduped_rows")))
    return per_date.join(deduped, "date")


def q_required_key_check(spark, sf_dir):
    """Documents of some visitors lose ``fullVisitorId`` or ``visitId``; the
    quarantine split keeps every row, in one of two outputs."""
    docs = session_docs_for(spark, sf_dir)
    doc = F.col("doc")
    doc = F.when(F.col("user_id") % 17 == 0,
                 F.regexp_replace(doc, r'"fullVisitorId":"[^"]*",', "")).otherwise(doc)
    doc = F.when(F.col("user_id") % 19 == 0,
                 F.regexp_replace(doc, r'"visitId":"[^"]*",', "")).otherwise(doc)
    c = to_compact(raw_from_text(docs.select(doc.alias("doc")))).select(*spec.REQUIRED_KEYS)
    valid, rejected = required_key_check(_staged(c, "checked"), mode="quarantine")   # both are read
    return (valid.select(F.lit("valid").alias("status"))
            .unionByName(rejected.select(F.lit("rejected").alias("status")))
            .groupBy("status").agg(F.count(F.lit(1)).alias("sessions")))


def q_not_in_filter(spark, sf_dir):
    hits = reports.hits_of(_compact(spark, sf_dir), AS_OF, 30)
    action = vtext("hit", "$.eCommerceAction.action_type")
    return (hits.select(action.alias("action_type"))
            .filter(~F.col("action_type").isin(*reports.EXCLUDED_ACTIONS))
            .groupBy("action_type").agg(F.count(F.lit(1)).alias("hits")))


# ------------------------------------------------------------------ flatten

def _per_session(df: DataFrame) -> DataFrame:
    return df.groupBy("fullVisitorId", "visitId").agg(F.count(F.lit(1)).alias("rows"))


def q_flatten_inner(spark, sf_dir):
    s = _compact(spark, sf_dir).select("fullVisitorId", "visitId", "hits")
    hits = flatten(s, "hits", "hit")
    return _per_session(flatten(hits, "hit", "product", path="$.product"))


def q_flatten_outer(spark, sf_dir):
    s = _compact(spark, sf_dir).select("fullVisitorId", "visitId", "hits")
    hits = flatten(s, "hits", "hit")
    return _per_session(flatten(hits, "hit", "product", path="$.product", outer=True))


def q_flatten_nested(spark, sf_dir):
    s = _compact(spark, sf_dir).select("fullVisitorId", "visitId", "hits")
    hits = flatten(s, "hits", "hit")
    products = flatten(hits, "hit", "product", path="$.product")
    dims = flatten(products, "product", "dim", path="$.customDimensions")
    return (dims.select("fullVisitorId", "visitId", vtext("dim", "$.value").alias("value"))
            .groupBy("fullVisitorId", "visitId", "value").agg(F.count(F.lit(1)).alias("rows")))


def q_flatten_fanout(spark, sf_dir):
    ex = explode_sessions(_compact(spark, sf_dir))
    return ex.groupBy("fullVisitorId", "visitId").agg(F.count(F.lit(1)).alias("rows"))


def q_exploded_refresh(spark, sf_dir):
    """Full refresh written and read back; a dozen of the 267 columns."""
    st = stage_for(spark, sf_dir)
    path = _run_dir(spark, "exploded")
    refresh_exploded(spark, st.compact, path)
    ex = snapshots.read(spark, path)
    return ex.select("fullVisitorId", "visitId", "date", "totals_visits", "hits_hitNumber",
                     "hits_eCommerceAction_action_type", "hits_promotion_promoName",
                     "hits_product_productSKU", "customDimensions_index", "customDimensions_value",
                     "hits_experiment_experimentId", "hits_customDimensions_value",
                     "hits_product_customDimensions_value")


def q_all_columns(spark, sf_dir):
    """All 267 columns of the written exploded table, of documents that fill them: the scalars as two
    hashes over their text in column order, the blobs as a count."""
    events = spread(table(spark, sf_dir, "events"), "event_id", "user_id")
    root = _run_dir(spark, "all_columns")
    upsert(to_compact(raw_from_text(full_docs(events))), f"{root}/compact")
    refresh_exploded(spark, f"{root}/compact", f"{root}/exploded")
    rows = snapshots.read(spark, f"{root}/exploded")
    scalars = [c.name for c in spec.EXPLODED if c.type != spec.VAR]
    blobs = [c.name for c in spec.EXPLODED if c.type == spec.VAR]
    half = len(scalars) // 2

    def digest(names):
        return F.md5(F.concat_ws("|", *[F.coalesce(F.col(n).cast("string"), F.lit("~")) for n in names]).cast("binary"))

    return rows.select(F.col("fullVisitorId").alias("visitor"), digest(scalars[:half]).alias("first_half"),
                       digest(scalars[half:]).alias("second_half"),
                       F.size(F.array_compact(F.array(*[F.col(n) for n in blobs]))).alias("blobs"))


def q_clustered_scan(spark, sf_dir):
    """Date-range read of the clustered table (partition filter + pushed
    visitor predicate)."""
    c = _compact(spark, sf_dir)
    return (c.filter((F.col("date") >= F.lit("2024-01-05").cast("date"))
                     & (F.col("date") <= F.lit("2024-01-09").cast("date"))
                     & F.col("fullVisitorId").isNotNull())
            .select("fullVisitorId", "visitId", "date", "totals_hits"))


def q_cast_lenient(spark, sf_dir):
    """Bad values under the lenient mode: ``visitNumber`` is unreadable text
    and ``date`` malformed for some visitors; strict mode would raise, lenient
    mode gives NULL and keeps every row."""
    docs = session_docs_for(spark, sf_dir)
    doc = F.col("doc")
    doc = F.when(F.col("user_id") % 7 == 0,
                 F.regexp_replace(doc, r'"visitNumber":"[^"]*"', '"visitNumber":"n/a"')).otherwise(doc)
    doc = F.when(F.col("user_id") % 9 == 0,
                 F.regexp_replace(doc, r'"date":"(\d{4})(\d{2})(\d{2})"', '"date":"$1-$2"')).otherwise(doc)
    c = to_compact(raw_from_text(docs.select(doc.alias("doc"))), strict=False)
    return c.select("fullVisitorId", "visitId", "visitNumber", "date")


def q_conversion_path_distinct_users(spark, sf_dir):
    return reports.conversion_path(_compact(spark, sf_dir), AS_OF, distinct_users=True)


def q_country_sessions_exact_key(spark, sf_dir):
    return reports.country_sessions(_compact(spark, sf_dir), AS_OF, exact_session_key=True)


def q_exploded_outer_promotions(spark, sf_dir):
    ex = explode_sessions(_compact(spark, sf_dir), outer_promotions=True, drop_unused=True)
    return ex.groupBy("fullVisitorId", "visitId").agg(F.count(F.lit(1)).alias("rows"))


def q_streaming_ingest(spark, sf_dir):
    """The landed files ingested by the incremental stream into a fresh table,
    then a second run that finds nothing new."""
    from hitloom.streaming import ingest_new_files
    root = _run_dir(spark, "stream")
    ingest_new_files(spark, _landing(spark, sf_dir), f"{root}/compact", f"{root}/checkpoint")
    ingest_new_files(spark, _landing(spark, sf_dir), f"{root}/compact", f"{root}/checkpoint")
    return _table_by_date(spark, f"{root}/compact")


# ------------------------------------------------------------------ upsert

def _split_batches(spark, sf_dir):
    batch = _batch(spark, sf_dir)
    first, second = SPLIT_DAY
    day = F.dayofmonth("date")
    return batch.filter(day <= first), batch.filter(day >= second)


def _table_by_date(spark, path):
    t = snapshots.read(spark, path)
    return t.groupBy("date").agg(F.count(F.lit(1)).alias("rows"),
                                 F.countDistinct(session_key()).alias("sessions"))


def q_upsert_first_load(spark, sf_dir):
    path = _run_dir(spark, "upsert_first")
    upsert(load_compact_batch(spark, _landing(spark, sf_dir)), path)
    return _table_by_date(spark, path)


def q_upsert_insert_only(spark, sf_dir):
    first, second = _split_batches(spark, sf_dir)
    path = _run_dir(spark, "upsert_insert")
    upsert(first, path)
    upsert(second, path)
    return _table_by_date(spark, path)


def q_upsert_idempotent(spark, sf_dir):
    batch = _batch(spark, sf_dir)
    path = _run_dir(spark, "upsert_twice")
    upsert(batch, path)
    upsert(batch, path)
    return _table_by_date(spark, path)


def q_upsert_late_documents(spark, sf_dir):
    """A batch of few documents, half of them known: every 50th visitor's come later, with every 25th's again."""
    batch = _batch(spark, sf_dir)
    visitor = F.col("fullVisitorId").cast("bigint")
    path = _run_dir(spark, "upsert_late")
    upsert(batch.where(visitor % 50 != 0), path)
    upsert(batch.where(visitor % 25 == 0), path)
    return _table_by_date(spark, path)


def q_upsert_update(spark, sf_dir):
    """Replace-on-key: every tenth order changes status, and as many new
    orders (negated keys) arrive in the same batch."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.year("o_orderdate").alias("o_year"))
    changed = orders.filter(F.col("o_orderkey") % 10 == 0).withColumn("o_orderstatus", F.lit("X"))
    added = changed.withColumn("o_orderkey", -F.col("o_orderkey"))
    path = _run_dir(spark, "upsert_orders")
    upsert(orders, path, keys=("o_orderkey",), partition_by="o_year", cluster_by="o_orderkey")
    upsert(changed.unionByName(added), path, keys=("o_orderkey",), partition_by="o_year",
           cluster_by="o_orderkey")
    return snapshots.read(spark, path).select("o_orderkey", "o_orderstatus", "o_totalprice",
                                           F.col("o_year").cast("int").alias("o_year"))


def q_upsert_moves_partitions(spark, sf_dir):
    """Replace-on-key that moves rows to other partitions and empties some.
    Partition values hold characters that folder names escape."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy:MM").alias("period"))
    moves = F.when(F.col("period").endswith(":02"), F.lit("all of February / x=y")) \
        .when(F.col("o_orderkey") % 10 == 0, F.lit("2030:01"))
    path = _run_dir(spark, "upsert_moves")
    how = dict(keys=("o_orderkey",), partition_by="period", cluster_by="o_orderkey")
    upsert(orders, path, **how)
    upsert(orders.withColumn("period", moves).where("period is not null"), path, **how)
    return snapshots.read(spark, path).select("o_orderkey", "o_totalprice", "period")


def q_upsert_null_keys(spark, sf_dir):
    """Rows with a NULL key match nothing, in the batch or in the table."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("key"),
        "o_orderkey", F.year("o_orderdate").alias("o_year"))
    path = _run_dir(spark, "upsert_null")
    for _ in range(2):
        upsert(orders, path, keys=("key",), partition_by="o_year", cluster_by="o_orderkey")
    return (snapshots.read(spark, path).groupBy("key", "o_orderkey")
            .agg(F.count(F.lit(1)).alias("rows")))


def _fanout_of(spark, path):
    return _per_session(snapshots.read(spark, path))


def q_exploded_after_replace(spark, sf_dir):
    """Sessions replaced by versions that give no exploded rows, for every
    fourth visitor and for a whole day; the exploded table follows."""
    batch = _batch(spark, sf_dir)
    root = _run_dir(spark, "exploded_replace")
    how = dict(keys=("fullVisitorId", "visitId"))
    upsert(batch, f"{root}/compact", **how)
    refresh_exploded(spark, f"{root}/compact", f"{root}/exploded")
    emptied = batch.where("cast(fullVisitorId AS bigint) % 4 = 0 OR date = DATE '2024-01-05'") \
        .withColumn("hits", F.lit(None).cast("variant"))
    upsert(emptied, f"{root}/compact", **how)
    refresh_exploded(spark, f"{root}/compact", f"{root}/exploded")
    return _fanout_of(spark, f"{root}/exploded")


def q_pipeline_two_runs(spark, sf_dir):
    """Date-foldered input; a run over part of it, a second that stops after
    the upsert, a third that finds nothing new but brings the exploded table
    up to date."""
    root = _run_dir(spark, "pipeline")
    docs = session_docs_for(spark, sf_dir)
    early = F.dayofmonth("day") <= 15
    write_json_files(docs.where(early), f"{root}/in/2024/early")
    write_json_files(docs.where(~early), f"{root}/in/2024/late/part")
    run_pipeline(spark, f"{root}/in/2024/early", f"{root}/out", AS_OF)
    run_pipeline(spark, f"{root}/in", f"{root}/out", AS_OF, exploded=False)
    run_pipeline(spark, f"{root}/in", f"{root}/out", AS_OF)
    return _fanout_of(spark, f"{root}/out/exploded")


def q_file_ledger(spark, sf_dir):
    """SRC-2, JOB-1: three runs by file (early days beside documents cut short; the late days come; nothing new).
    What the ledger says of each folder, what the raw table holds of it, and the compact table."""
    root = _run_dir(spark, "ledger")
    docs = session_docs_for(spark, sf_dir)
    early = F.dayofmonth("day") <= 10
    write_json_files(docs.where(early), f"{root}/in/early")
    write_json_files(docs.where("user_id % 5 = 0").withColumn("doc", F.substring("doc", 1, 20)), f"{root}/in/cut")
    run = lambda: run_pipeline(spark, f"{root}/in", f"{root}/out", AS_OF, exploded=False, by_file=True, rejected="table", view_prefix="by_file_")
    run()
    write_json_files(docs.where(~early), f"{root}/in/late")
    table = run().files.table
    assert run().files.loaded == 0

    def folder(path):
        return F.regexp_extract(path, "/in/([a-z]+)/", 1).alias("folder")

    held = ledger.read_rows(spark, table).groupBy(folder("source_file")).agg(F.count(F.lit(1)).alias("in_table"))
    said = (ledger.read_ledger(spark, table).groupBy(folder("file"), "state")
            .agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows")))
    n = snapshots.read(spark, f"{root}/out/compact").agg(F.count(F.lit(1)).alias("rows"))
    return said.join(held, "folder").unionByName(n.select(
        F.lit("compact").alias("folder"), F.lit("merged").alias("state"), "rows", F.lit(0).cast("bigint").alias("bad_rows"), F.col("rows").alias("in_table")))


def _as_text(tables: dict[str, DataFrame]) -> DataFrame:
    """All seven reports, each row as text beside its report's name (their columns differ)."""
    out = None
    for report, rows in tables.items():
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("decimal(30,4)" if t == "double" else "string").cast("string"), F.lit("~"))
                                  for c, t in rows.dtypes])
        rows = rows.select(F.lit(report).alias("report"), text.alias("row"))
        out = rows if out is None else out.unionByName(rows)
    return out


def q_views_follow_table(spark, sf_dir):
    """Views created over the first ten days only; then an append of the rest, and a replacement of every
    fourth visitor's sessions by ones without hits.  The same views are asked after all that."""
    batch = _batch(spark, sf_dir)
    root = _run_dir(spark, "views")
    how = dict(keys=("fullVisitorId", "visitId"))
    upsert(batch.where(F.dayofmonth("date") <= 10), f"{root}/compact", **how)
    views.publish_views(spark, f"{root}/compact", AS_OF, prefix="followed_")
    for name in reports.VIEW_NAMES.values():
        spark.sql(f"SELECT * FROM followed_{name}").collect()
    upsert(batch, f"{root}/compact")
    upsert(batch.where("cast(fullVisitorId AS bigint) % 4 = 0").withColumn("hits", F.lit(None).cast("variant")), f"{root}/compact", **how)
    return _as_text({r: spark.sql(f"SELECT * FROM `followed_{n}`") for r, n in reports.VIEW_NAMES.items()})


def q_report_tables_current(spark, sf_dir):
    """SNK-6: the report tables after three upserts (ten days; the rest; every fourth visitor's sessions
    replaced by ones without hits), each followed by a refresh from the partials of the changed dates."""
    batch = _batch(spark, sf_dir)
    root = _run_dir(spark, "report_tables")
    how = dict(keys=("fullVisitorId", "visitId"))
    upsert(batch.where(F.dayofmonth("date") <= 10), f"{root}/compact", **how)
    refresh_report_tables(spark, f"{root}/compact", f"{root}/reports", AS_OF)
    upsert(batch, f"{root}/compact")
    refresh_report_tables(spark, f"{root}/compact", f"{root}/reports", AS_OF)
    upsert(batch.where("cast(fullVisitorId AS bigint) % 4 = 0").withColumn("hits", F.lit(None).cast("variant")), f"{root}/compact", **how)
    done = refresh_report_tables(spark, f"{root}/compact", f"{root}/reports", AS_OF)
    return _as_text({r: snapshots.read(spark, path) for r, path in done.paths.items()})


def q_exploded_hot_sessions(spark, sf_dir):
    """The fan-out with every session of five or more hits taken apart and dealt by hit."""
    ex = explode_sessions(_compact(spark, sf_dir), heavy_hits=5)
    return ex.groupBy("fullVisitorId", "visitId").agg(F.count(F.lit(1)).alias("rows"), F.sum("hits_hitNumber").alias("hit_numbers"))


def q_exploded_other_options(spark, sf_dir):
    """A default run over half the days, then a run with other options that brings the rest: the
    exploded table equals a full refresh with the new options."""
    root = _run_dir(spark, "options")
    docs = session_docs_for(spark, sf_dir)
    write_json_files(docs.where(F.dayofmonth("day") <= 15), f"{root}/in/early")
    write_json_files(docs.where(F.dayofmonth("day") > 15), f"{root}/in/late")
    run_pipeline(spark, f"{root}/in/early", f"{root}/out", AS_OF, view_prefix="options_")
    run_pipeline(spark, f"{root}/in", f"{root}/out", AS_OF, outer_promotions=True, drop_unused=True, view_prefix="options_")
    return _fanout_of(spark, f"{root}/out/exploded")


def q_signed_ratio(spark, sf_dir):
    """Ratios of amounts that refunds make negative."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    net = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderkey") % 3 == 0, -cents * 4).otherwise(cents)).alias("net"),
        F.count(F.lit(1)).alias("orders"))
    return net.select("o_custkey", ratio("net", "orders * 8", 0).alias("whole"),
                      ratio("net", "-orders * 8", 2).alias("turned"))


def _with_defaults(fn: Query) -> Query:
    """Every query runs under the library's SQL settings (UTC session time
    zone for the epoch arithmetic on ``events.ts``, ANSI mode)."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        set_session_defaults(spark)
        return fn(spark, sf_dir)
    q.__name__ = getattr(fn, "__name__", "query")
    q.__doc__ = fn.__doc__
    return q


_QUERIES: dict[str, Query] = {
    **{name: _report(name) for name in reports.REPORTS},
    "unique_page_views_titled": q_unique_page_views_titled,
    "ordered_report": q_ordered_report,
    "ordered_ascending": q_ordered_ascending,
    "ordered_two_columns": q_ordered_two_columns,
    "report_of_today": q_report_of_today,
    "raw_scan": q_raw_scan,
    "path_extract": q_path_extract,
    "cast_strict": q_cast_strict,
    "date_parse": q_date_parse,
    "date_cutoff": q_date_cutoff,
    "sessions_distinct": q_sessions_distinct,
    "content_dedupe": q_content_dedupe,
    "required_key_check": q_required_key_check,
    "not_in_filter": q_not_in_filter,
    "flatten_inner": q_flatten_inner,
    "flatten_outer": q_flatten_outer,
    "flatten_nested": q_flatten_nested,
    "flatten_fanout": q_flatten_fanout,
    "exploded_refresh": q_exploded_refresh,
    "all_columns": q_all_columns,
    "clustered_scan": q_clustered_scan,
    "upsert_first_load": q_upsert_first_load,
    "upsert_insert_only": q_upsert_insert_only,
    "upsert_idempotent": q_upsert_idempotent,
    "upsert_late_documents": q_upsert_late_documents,
    "upsert_update": q_upsert_update,
    "upsert_moves_partitions": q_upsert_moves_partitions,
    "upsert_null_keys": q_upsert_null_keys,
    "exploded_after_replace": q_exploded_after_replace,
    "pipeline_two_runs": q_pipeline_two_runs,
    "signed_ratio": q_signed_ratio,
    "views_follow_table": q_views_follow_table,
    "report_tables_current": q_report_tables_current,
    "file_ledger": q_file_ledger,
    "exploded_other_options": q_exploded_other_options,
    "exploded_hot_sessions": q_exploded_hot_sessions,
    "cast_lenient": q_cast_lenient,
    "conversion_path_distinct_users": q_conversion_path_distinct_users,
    "country_sessions_exact_key": q_country_sessions_exact_key,
    "exploded_outer_promotions": q_exploded_outer_promotions,
    "streaming_ingest": q_streaming_ingest,
    **{f"sql_{name}": _sql(name) for name in reports.REPORTS},
    **{f"hits_{name}": _from_hits(name)
       for name in ("conversion_path", "promotion_ctr", "unique_page_views")},
}
QUERIES: dict[str, Query] = {name: _with_defaults(fn) for name, fn in _QUERIES.items()}
