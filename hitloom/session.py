"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings this library relies on; applied to a session it creates.  On a
# session it is handed, ``set_session_defaults`` sets the four that results
# or wide plans depend on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The stage tables are wide (84 and 267 columns); at the default of 100
    # fields whole-stage code generation is switched off for them.
    "spark.sql.codegen.maxFields": "1000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "hitloom", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    Read from the session's ``spark.checkpoint.dir`` (on a cluster this is the
    shared file system the operator configured).  Only when it is unset --
    local runs and tests -- a fresh folder is made and registered as the
    checkpoint dir, so later calls in the same session agree.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        cp = sc.getCheckpointDir()
        if cp:
            base = cp.rstrip("/").rsplit("/", 1)[0]
        elif sc.master == "local" or sc.master.startswith("local["):
            base = tempfile.mkdtemp(prefix="hitloom-")
            sc.setCheckpointDir(base)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(a driver-local temporary folder is not visible to them)")
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/") + "/hitloom"


def set_session_defaults(spark: SparkSession) -> None:
    """Apply the SQL settings the reports depend on to an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.sources.partitionOverwriteMode", "spark.sql.codegen.maxFields"):
        spark.conf.set(k, DEFAULT_CONF[k])


@contextmanager
def conf_override(spark: SparkSession, settings: dict[str, str]):
    """Set SQL settings for the duration of one (synchronous) write."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
