import gzip

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from hitloom.sources.raw import list_input_files, load_raw
from hitloom.functions.variant import vget


def _write(path, lines, gz=False):
    data = "\n".join(lines) + "\n"
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(data)
    else:
        path.write_text(data)


def test_e18_ingest_modes(spark, tmp_path):
    good = '{"fullVisitorId":"1","visitId":"5"}'
    arr = '[{"fullVisitorId":"2","visitId":"6"},{"fullVisitorId":"3","visitId":"7"}]'
    _write(tmp_path / "a.json", [good, "", arr])
    _write(tmp_path / "b.json.gz", [good], gz=True)
    raw = load_raw(spark, str(tmp_path), with_source=True)
    ids = sorted(r.v for r in raw.select(vget("raw_text", "$.fullVisitorId", "string").alias("v")).collect())
    assert ids == ["1", "1", "2", "3"]          # blank skipped, array split, gzip read
    assert len(list_input_files(spark, str(tmp_path))) == 2

    bad_dir = tmp_path / "bad"
    bad_dir.mkdir()
    _write(bad_dir / "c.json", [good, '{"fullVisitorId": ', '{"a":1,"a":2}'])
    with pytest.raises((PySparkException, Py4JJavaError)):     # FAILFAST
        load_raw(spark, str(bad_dir)).collect()
    assert load_raw(spark, str(bad_dir), mode="DROPMALFORMED").count() == 1
    perm = load_raw(spark, str(bad_dir), mode="PERMISSIVE", split_arrays=False).collect()
    assert len(perm) == 3 and sum(r.raw_text is None for r in perm) == 2


def test_few_large_files_are_spread_before_extraction(spark, tmp_path):
    _write(tmp_path / "one.json.gz", ['{"fullVisitorId":"%d","visitId":"1"}' % i for i in range(50)],
           gz=True)
    assert load_raw(spark, str(tmp_path)).rdd.getNumPartitions() == 1
    spread = load_raw(spark, str(tmp_path), spread=4)
    assert spread.rdd.getNumPartitions() == 4 and spread.count() == 50


def test_sub_folders_are_read_as_they_are_listed(spark, tmp_path):
    for i, sub in enumerate((".", "date=2024-01-01", "2024/02/x")):
        (tmp_path / sub).mkdir(parents=True, exist_ok=True)
        _write(tmp_path / sub / "a.json", ['{"fullVisitorId":"%d","visitId":"1"}' % i])
    raw = load_raw(spark, str(tmp_path), with_source=True)
    assert raw.columns == ["raw_text", "source_file"]
    assert sorted(r.source_file.split("/")[-2] for r in raw.collect()) == sorted(
        f.split("/")[-2] for f in list_input_files(spark, str(tmp_path)))
    assert load_raw(spark, str(tmp_path), path_glob="*.gz").count() == 0
