"""The pipeline in order: raw load -> compact upsert -> exploded refresh -> reports.

``run_pipeline`` is the general entry point over any folder of JSON session
files.  ``stage_for`` builds the same stages once per driver test-data folder
(session documents from ``events`` landed as gzip JSON files, then the real
ingest path) and reuses them while the inputs and the code are unchanged.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import threading
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs, spec
from hitloom.functions import variant
from hitloom.operators import compact as compact_module
from hitloom.operators import explode, flatten, snapshots
from hitloom.operators.compact import missing_key, required_key_check, to_compact
from hitloom.operators.explode import explode_sessions
from hitloom.operators.snapshots import Conflict
from hitloom.operators.upsert import MAX_RECORDS_PER_FILE, PARTITION_COLUMN, TRIES, UpsertResult, table_schema, upsert
from hitloom.plans.reports import VIEW_NAMES, run_all
from hitloom.plans.views import publish_views
from hitloom.session import conf_override, set_session_defaults, work_dir
from hitloom.sources import ledger
from hitloom.sources.fixtures import session_docs_for
from hitloom.sources.raw import RAW_COLUMN, load_raw, write_json_files


@dataclass
class PipelineResult:
    raw_path: str
    compact_path: str
    exploded_path: str | None
    upsert: UpsertResult
    reports: dict[str, DataFrame]
    # Report -> name of the view that answers it.
    views: dict[str, str] = field(default_factory=dict)
    rejected_path: str | None = None
    # Report -> path of its table, with ``current_reports``.
    report_tables: dict[str, str] = field(default_factory=dict)
    # What the load met, with ``by_file``.
    files: ledger.LoadResult | None = None


def load_compact_batch(spark: SparkSession, input_path: str, strict: bool = True,
                       mode: str = "FAILFAST", spread: int | None = None,
                       multi_line: bool = False) -> DataFrame:
    """JOB-1 + extraction: JSON files -> raw variant -> typed compact rows,
    with the NOT NULL check on the identity columns."""
    raw = load_raw(spark, input_path, mode=mode, spread=spread, multi_line=multi_line)
    return required_key_check(to_compact(raw, strict=strict), mode="error")


def rejected_rows(raw: DataFrame) -> DataFrame:
    """Documents of ``raw`` (raw_text, source_file) that the compact table cannot take: source_file, reason, document.

    Reads four paths of a document: malformed text (a NULL document in the PERMISSIVE
    mode), a missing or unreadable key, an unreadable date.  Every other document is valid, so the
    counts of both add up to the input's."""
    doc = F.col(RAW_COLUMN)
    keys = [F.when(variant.vget(RAW_COLUMN, c.json_path, c.type, strict=False).isNull(), F.lit(f"no {c.name}"))
            for c in spec.COMPACT if c.name in spec.REQUIRED_KEYS]
    date = next(c for c in spec.COMPACT if c.name == PARTITION_COLUMN)
    bad_date = (variant.vtext(RAW_COLUMN, date.json_path).isNotNull()
                & variant.vget(RAW_COLUMN, date.json_path, date.type, strict=False).isNull())
    reason = F.when(doc.isNull(), F.lit("malformed document")).otherwise(
        F.concat_ws(", ", *keys, F.when(bad_date, F.lit(f"unreadable {PARTITION_COLUMN}"))))
    return (raw.select("source_file", reason.alias("reason"), F.to_json(doc).alias("document")).where(F.col("reason") != ""))


EXPLODED_OPEN_FILES = 16


def build_signature(modules: list, **options) -> str:
    """What a derived table is built by: the source text of ``modules`` and the options."""
    text = "".join(inspect.getsource(m) for m in modules) + json.dumps(options, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def refresh_derived(spark: SparkSession, source: str, path: str, build: Callable[[DataFrame], DataFrame],
                    full: bool = False, signature: str = "") -> list[str] | None:
    """Bring the table at ``path`` to ``build`` of the table at ``source``, partitioned by date: whole, or
    only the dates that changed since it was last built.  Returns the rebuilt partitions (None: all).

    The derived table's own pointer notes which generations of every source partition it was built from, and
    the ``signature`` of the build.  Partitions whose generations differ are rebuilt, whoever changed
    them (an interrupted run, a separate upsert, the stream); another signature (other options, other code)
    means a full refresh.  The rows of a date depend on the source rows of that date alone, so the
    result equals a full refresh.  Readers see the old or the new table (see ``snapshots``).

    Compact files sit in per-date folders and hold ranges of visitors, so a task's rows come from a few
    dates and the written files hold ranges too; the writer keeps one open file per date (up to
    ``EXPLODED_OPEN_FILES``) instead of sorting wide rows by date, and falls back to sorting only past
    that limit.  Variant blobs are written unshredded: every field is already a typed column."""
    set_session_defaults(spark)
    for attempt in range(TRIES):
        src = snapshots.adopt(spark, source, PARTITION_COLUMN)
        if src is None:
            raise FileNotFoundError(f"no table at {source}")
        now = {p: list(g) for p, g in src.parts.items()}
        mine = snapshots.state(spark, path)
        built = mine.note.get("built") if mine else None
        changed = None
        if not full and built and built["signature"] == signature:
            old = built["source"]
            changed = sorted(p for p in {*old, *now} if old.get(p) != now.get(p))
            if not changed:
                return []
        gen = snapshots.new_generation(mine)
        rows = build(snapshots.read(spark, source, changed, at=src))
        with conf_override(spark, {"spark.sql.variant.writeShredding.enabled": "false",
                                   "spark.sql.optimizer.plannedWrite.enabled": "false",
                                   "spark.sql.maxConcurrentOutputFileWriters": str(EXPLODED_OPEN_FILES)}):
            (rows.write.mode("overwrite").partitionBy(PARTITION_COLUMN).option("partitionOverwriteMode", "static")
             .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(snapshots.generation_path(path, gen)))
        stay = {} if changed is None else {p: g for p, g in mine.parts.items() if p not in changed}
        new = {p: (gen,) for p in snapshots.written_parts(spark, path, gen, PARTITION_COLUMN)}
        note = {"schema": table_schema(rows, PARTITION_COLUMN), "built": {"signature": signature, "source": now}}
        try:
            snapshots.publish(spark, path, mine, {**stay, **new}, note)
        except Conflict:
            fs.delete(spark, snapshots.generation_path(path, gen))
            if attempt == TRIES - 1:
                raise
            continue
        if mine is None:  # created or replaced: what lay there without a pointer goes
            for name in fs.child_names(spark, path):
                if not name.startswith("gen="):
                    fs.delete(spark, f"{path}/{name}")
        return changed
    raise AssertionError("unreachable")


def refresh_exploded(spark: SparkSession, compact_path: str, exploded_path: str,
                     full: bool = False, outer_promotions: bool = False, drop_unused: bool = False) -> list[str] | None:
    """JOB-3: refresh of the exploded table from the compact table."""
    options = dict(outer_promotions=outer_promotions, drop_unused=drop_unused)
    signature = build_signature([spec, variant, flatten, compact_module, explode], **options)
    return refresh_derived(spark, compact_path, exploded_path, lambda compact: explode_sessions(compact, **options), full, signature)


def write_raw_table(spark: SparkSession, input_path: str, raw_path: str,
                    mode: str = "FAILFAST") -> None:
    """Replace the raw table (one variant column) with the documents of the
    input files, unshredded: it is read whole by the extraction."""
    with conf_override(spark, {"spark.sql.variant.writeShredding.enabled": "false"}):
        load_raw(spark, input_path, mode=mode).write.mode("overwrite").parquet(raw_path)


def materialize_reports(reports: dict[str, DataFrame], out_dir: str, names: dict[str, str] | None = None) -> dict[str, str]:
    """Write every report as a table (overwrite) instead of a view."""
    paths = {}
    for name, df in reports.items():
        paths[name] = f"{out_dir}/{ {**VIEW_NAMES, **(names or {})}[name]}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths


def run_pipeline(spark: SparkSession, input_path: str, out_dir: str, as_of=None,
                 exploded: bool = True, keys=None, keep_raw: bool = False,
                 report_tables: bool = False, full_refresh: bool = False,
                 hit_table: bool = False, strict: bool = True, mode: str = "FAILFAST",
                 multi_line: bool = False, spread: int | None = None, duplicates: str = "first",
                 outer_promotions: bool = False, drop_unused: bool = False, rejected: str = "error", current_reports: bool = False,
                 by_file: bool = False, view_names: dict[str, str] | None = None, view_prefix: str = "", view_schema: str | None = None) -> PipelineResult:
    """JOB-5: all stages in order, as plain calls.

    ``keep_raw`` also replaces a raw table ``<out>/raw`` and extracts from it;
    ``report_tables`` writes the reports under ``<out>/reports``;
    ``current_reports`` keeps them as tables under ``<out>/current`` from partial
    results per date (see ``report_tables.refresh_report_tables``).  The
    exploded table is rebuilt for the dates that changed since it was last
    built, or whole with ``full_refresh`` (and always the first time, and when the
    options or the code differ from the last build's);
    ``hit_table`` keeps the per-hit table ``<out>/hits`` the same way and
    publishes the three hit-level reports from it.  ``strict``, ``mode``,
    ``multi_line`` and ``spread`` go to the reader and the casts,
    ``duplicates`` to the upsert, the next two to the exploded table.
    ``rejected="table"`` does not stop at a document that the compact table cannot take but
    appends it, with its file and the reason, to ``<out>/rejected`` (one folder a run; it
    sets ``mode`` to PERMISSIVE).  ``by_file`` loads only files that ``<out>/files`` does not hold
    yet, each whole or not at all, and keeps a result for every one (see ``sources.ledger``); loads that a
    stopped run has left are merged by the next.  The views follow the tables; ``view_*`` name them
    (see ``publish_views``)."""
    if rejected not in ("error", "table"):
        raise ValueError(f"unknown rejected policy {rejected!r}")
    if by_file and keep_raw:
        raise ValueError("by_file keeps a raw table of its own")
    set_session_defaults(spark)
    compact_path, rejected_path = f"{out_dir}/compact", None
    if rejected == "table":
        mode = "PERMISSIVE"
    if keep_raw:
        raw_path = f"{out_dir}/raw"
        write_raw_table(spark, input_path, raw_path, mode)
    met, loads = None, []
    if by_file:
        met = ledger.load_files(spark, input_path, f"{out_dir}/files", multi_line=multi_line)
        loads = ledger.pending(spark, met.table, "compact")
        raw_rows = ledger.read_rows(spark, met.table, loads)
    if rejected == "table":
        rejected_path = f"{out_dir}/rejected"
        raw = raw_rows if by_file else load_raw(spark, input_path, mode=mode, spread=spread, multi_line=multi_line, with_source=True)
        raw_bad = rejected_rows(raw)
        raw_bad.write.mode("append").parquet(rejected_path)
    if by_file:
        raw = raw_rows.select(RAW_COLUMN)
    else:
        raw = spark.read.parquet(raw_path) if keep_raw else load_raw(spark, input_path, mode=mode, spread=spread, multi_line=multi_line)
    if rejected == "table":
        valid = raw.where(F.col(RAW_COLUMN).isNotNull())
        fine = ~missing_key()
        for c in spec.COMPACT:
            if c.name == PARTITION_COLUMN:
                text = variant.vtext(RAW_COLUMN, c.json_path)
                valid = valid.where(text.isNull() | variant.vget(RAW_COLUMN, c.json_path, c.type, strict=False).isNotNull())
            elif c.name in spec.REQUIRED_KEYS:
                valid = valid.where(variant.vget(RAW_COLUMN, c.json_path, c.type, strict=False).isNotNull())
        batch = to_compact(valid, strict=strict).where(fine)
    else:
        batch = required_key_check(to_compact(raw, strict=strict), mode="error")
    if by_file and not loads and snapshots.state(spark, compact_path):
        res = UpsertResult(compact_path, False, 0, touched=[])
    else:
        res = upsert(batch, compact_path, keys=keys or spec.DEFAULT_MERGE_KEYS, duplicates=duplicates)
    if loads:
        ledger.mark_merged(spark, met.table, "compact", loads)
    exploded_path, hits, hits_path = None, None, None
    if exploded:
        exploded_path = f"{out_dir}/exploded"
        refresh_exploded(spark, compact_path, exploded_path, full_refresh, outer_promotions, drop_unused)
    if hit_table:
        from hitloom.plans.hit_reports import refresh_hits
        hits_path = f"{out_dir}/hits"
        refresh_hits(spark, compact_path, hits_path, full_refresh)
        hits = snapshots.read(spark, hits_path)
    reports = run_all(snapshots.read(spark, compact_path), as_of, hits=hits)
    if report_tables:
        materialize_reports(reports, f"{out_dir}/reports", view_names)
    views = publish_views(spark, compact_path, as_of, view_names, view_prefix, view_schema, hits_path)
    current = {}
    if current_reports:
        from hitloom.plans.report_tables import refresh_report_tables
        current = refresh_report_tables(spark, compact_path, f"{out_dir}/current", as_of, names=view_names,
                                        hits_path=hits_path, full=full_refresh).paths
    return PipelineResult(input_path, compact_path, exploded_path, res, reports, views, rejected_path, current, met)


# ---------------------------------------------------------------- test stages

def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(sf_dir.encode())
    root = Path(__file__).resolve().parents[1]
    for source in sorted(root.glob("*.py")) + [p for d in ("functions", "operators", "plans", "sources")
                                               for p in sorted((root / d).glob("*.py"))]:
        h.update(source.read_bytes())
    jvm = spark.sparkContext._jvm
    for name in ("events", "nation", "region"):
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        st = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
        h.update(f"{name}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


@dataclass
class Stages:
    root: str
    landing: str
    compact: str
    exploded: str
    hits: str


def stage_paths(spark: SparkSession, sf_dir: str) -> Stages:
    root = f"{work_dir(spark)}/stages/{_fingerprint(spark, sf_dir)}"
    return Stages(root, f"{root}/landing", f"{root}/compact", f"{root}/exploded", f"{root}/hits")


def land_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Session documents from ``events`` as gzip JSON-lines files."""
    write_json_files(session_docs_for(spark, sf_dir), path)


_STAGE_LOCK = threading.Lock()


def stage_for(spark: SparkSession, sf_dir: str, exploded: bool = False,
              hits: bool = False, compact: bool = True) -> Stages:
    """Landing files and compact table for a test-data folder (built once;
    concurrent callers in one process wait for the first build).  ``hits``
    also builds the per-hit table; without ``compact`` only the files are built."""
    with _STAGE_LOCK:
        return _stage_for(spark, sf_dir, exploded, hits, compact)


def _stage_for(spark: SparkSession, sf_dir: str, exploded: bool, hits: bool = False, compact: bool = True) -> Stages:
    st = stage_paths(spark, sf_dir)
    if not fs.exists(spark, f"{st.landing}/_SUCCESS"):
        land_documents(spark, sf_dir, st.landing)
    if not compact:
        return st
    if not fs.exists(spark, f"{st.root}/_COMPACT_DONE"):
        upsert(load_compact_batch(spark, st.landing), st.compact)
        fs.write_text(spark, f"{st.root}/_COMPACT_DONE", "1")
    if exploded and snapshots.state(spark, st.exploded) is None:
        refresh_exploded(spark, st.compact, st.exploded)
    if hits and snapshots.state(spark, st.hits) is None:
        from hitloom.plans.hit_reports import refresh_hits
        refresh_hits(spark, st.compact, st.hits)
    return st
