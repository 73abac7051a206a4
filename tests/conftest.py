from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hitloom.session import get_spark  # noqa: E402
from hitloom.sources.raw import raw_from_text  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", app="hitloom-tests", **{"spark.sql.shuffle.partitions": "8"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hitloom-test-"))
    yield s


@pytest.fixture()
def tmp_table(tmp_path):
    return str(tmp_path / "table")


def docs(spark, *documents):
    """Raw variant frame from Python dicts (or ready JSON text)."""
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return raw_from_text(spark.createDataFrame(rows, "doc string"))


def session(visitor="1", visit="19723", date="20240101", **extra):
    d = {"fullVisitorId": visitor, "visitId": visit, "date": date,
         "totals": {"visits": "1", "hits": "1"}}
    d.update(extra)
    return d
