"""Benchmark: the whole pipeline and the seven reports at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARMUP_DIR (default /root/testdata/sf0.001; empty to skip).
Prints one JSON line.  ``value`` is the sum of the pipeline stages and the
reports; landing the session documents (test-data preparation from
``events``) and the optional per-hit table with its reports (``extra_*``)
are timed separately and not part of ``value``.

The same sequence first runs once, untimed, on the small warm-up folder so
that JIT and code-generation time (a fixed cost of a few seconds per distinct
plan, which dominates at sf0.1 but not at scale) is not counted; the cold
first-pass times are reported under ``warmup``.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hitloom.operators import snapshots  # noqa: E402
from hitloom.operators.upsert import upsert  # noqa: E402
from hitloom.plans.catalog import AS_OF  # noqa: E402
from hitloom.plans.hit_reports import HIT_REPORTS, refresh_hits  # noqa: E402
from hitloom.plans.pipeline import land_documents, load_compact_batch, refresh_exploded  # noqa: E402
from hitloom.plans.reports import REPORTS  # noqa: E402
from hitloom.session import get_spark, work_dir  # noqa: E402


def run_once(spark, sf_dir: str):
    root = f"{work_dir(spark)}/bench/{uuid.uuid4().hex}"
    landing, compact, exploded = f"{root}/landing", f"{root}/compact", f"{root}/exploded"
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    timed("land_documents", lambda: land_documents(spark, sf_dir, landing))
    first = timed("compact_first_load", lambda: upsert(load_compact_batch(spark, landing), compact))
    again = timed("compact_upsert_rerun", lambda: upsert(load_compact_batch(spark, landing), compact))
    timed("exploded_refresh", lambda: refresh_exploded(spark, compact, exploded))
    table = snapshots.read(spark, compact)
    for name, fn in REPORTS.items():
        timed(name, lambda fn=fn: fn(table, AS_OF).collect())
    # Optional per-hit table and the hit-level reports over it (not in value).
    hits = f"{root}/hits"
    timed("extra_hits_table_build", lambda: refresh_hits(spark, compact, hits))
    hit_table = snapshots.read(spark, hits)
    for name, fn in HIT_REPORTS.items():
        timed(f"extra_hits_{name}", lambda fn=fn: fn(hit_table, AS_OF).collect())
    return times, first, again


def _sf(sf_dir: str):
    name = Path(sf_dir).name.removeprefix("sf")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="hitloom-bench", **{
        "spark.sql.shuffle.partitions": str(2 * cpus),
        "spark.driver.memory": "8g",
    })
    warmup_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warm = run_once(spark, warmup_dir)[0] if warmup_dir else {}
    warm = {k: v for k, v in warm.items() if not k.startswith("extra_")}
    times, first, again = run_once(spark, sf_dir)

    pipeline = {k: v for k, v in times.items()
                if k != "land_documents" and not k.startswith("extra_")}
    print(json.dumps({
        "metric": "pipeline_and_reports_total",
        "value": round(sum(pipeline.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": _sf(sf_dir),
        "rows": {"sessions_loaded": first.inserted, "rerun_inserted": again.inserted},
        "cpus": cpus,
        "warmup": {"dir": warmup_dir, "total": round(sum(v for k, v in warm.items()
                                                         if k != "land_documents"), 3)},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
