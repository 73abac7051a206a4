import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from hitloom.llm import warc

SCHEMA = "record_id string, warc_type string, target_uri string, warc_date timestamp, http_header string, payload_digest string, payload string, status string, url string"
DAY0 = dt.datetime(2024, 3, 1)


def rec(i, kind, url, minutes, *headers, code="200 OK", digest=None):
    at = None if minutes is None else DAY0 + dt.timedelta(minutes=minutes)
    return (i, kind, url, at, "\r\n".join([f"HTTP/1.1 {code}", *headers]), digest, f"body of {i}", "x", "x")


def full(i, url, minutes, *headers, **k):
    return rec(i, "response", url, minutes, *headers, **k)


def again(i, url, minutes, *headers, **k):
    return rec(i, "revisit", url, minutes, *headers, code="304 Not Modified", **k)


def resolved(spark, rows):
    got = warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r.record_id: r for r in got}


def test_validators_dates_and_headers(spark):
    u, v = "http://www.Example.com:80/a/?b=2&utm_source=x&a=1#frag", "https://example.com/a?a=1&b=2"
    rows = [
        full("r1", u, 0, 'ETag: "one"', "Content-Length: 9", "X-A: 1", "X-A: 2", "Cache-Control: no"), full("r2", v, 60 * 30, 'ETag: W/"two"', "Last-Modified: L"),
        full("r3", u, 60 * 30, 'ETag: "late"'), full("p", v, 60 * 31, 'ETag: "part"', code="206 Partial Content"), full(None, v, 60 * 31, 'ETag: "no id"'),
        again("a", v, 5, 'etag: "one"', "Content-Length: 0", "x-a: 3", "Connection: close, X-Hop", "X-Hop: 1", "Age: 4"),
        again("b", v, 60 * 40, 'ETag: "late"'), again("c", v, 0, 'ETag: "one"'), again("d", v, 60 * 40, "Last-Modified: L"), again("e", v, 60 * 40),
        again("f", None, 5), again("g", "not a url", 5), again("h", v, None), again("i", "http://other.org/", 5), again("j", v, 60 * 40, digest="q")]
    got = resolved(spark, rows)
    status = {k: r.status for k, r in got.items()}
    assert status == {"a": "resolved", "b": "resolved", "c": "no_earlier_response", "d": "mismatch", "e": "no_validator", "f": "no_url", "g": "no_url",
                      "h": "no_date", "i": "no_earlier_response", "j": "mismatch"}
    assert got["a"].refers_to == "r1" and got["a"].payload == "body of r1" and got["b"].refers_to == "r3" and got["e"].payload is None
    assert [tuple(h) for h in got["a"].headers] == [("content-length", "9"), ("cache-control", "no"), ("etag", '"one"'), ("x-a", "3"), ("age", "4")]


def test_as_of_against_brute_force(spark):
    rng = random.Random(9)
    urls = ["http://hot.org/"] * 6 + [f"http://h{i}.org/{i}" for i in range(4)]
    rows = [(full if rng.random() < 0.4 else again)(f"{i:04d}", rng.choice(urls), rng.choice([rng.randint(0, 9000), 1440, 2880]), 'ETag: "e"') for i in range(500)]
    got = resolved(spark, rows)
    for r in rows:
        if r[1] == "revisit":
            before = [(s[3], s[0]) for s in rows if s[1] == "response" and s[2] == r[2] and s[3] < r[3]]
            assert got[r[0]].refers_to == (max(before)[1] if before else None)


def test_repeated_records(spark):
    rows = [full("r", "http://a.org/x", 0, 'ETag: "e"')] * 3 + [again("v", "http://a.org/x/", 9, 'ETag: "e"')] * 2
    got = warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.status for r in got] == ["resolved"] * 2
    assert warc.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("url,want", [
    ("HTTP://User:pw@WWW.Host.COM:443/P/Q//?z=1&a&fbclid=3&UTM_medium=2#x", "host.com/P/Q?a&z=1"), ("https://host.com", "host.com"),
    ("https://host.com:8080/", "host.com:8080"), ("ftp://h/x?", "h/x"), ("", None), (None, None), ("http:///x", None), ("mailto:a@b", None)])
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == want


def test_captures_carry_the_body_and_revisits_get_it_back(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.org/", None if i == 4 else f"<p>é{i}</p>" * i) for i in range(12)], "page_id long, url string, html string")
    records = warc.captures_of(pages)
    want = {i: "" if i == 4 else f"<p>é{i}</p>" * i for i in range(12)}
    bodies = {r.record_id: r.payload for r in records.collect()}
    assert all(body == (want[int(i[:20])] if i[20:] == "a" else None) for i, body in bodies.items())
    found = warc.resolve_revisits(records).collect()
    assert all(r.payload == (want[int(r.record_id[:20])] if r.status == "resolved" else None) for r in found)
    assert sum(r.status == "resolved" for r in found) == 12 + 4


def test_long_queries_are_read_to_their_end(spark):
    urls = [("http://h/x?a=" + "0" * 1_000_010 + end,) for end in ("1", "2")]
    assert spark.createDataFrame(urls, "u string").select(warc.canonical_url(F.col("u"))).distinct().count() == 2


def test_repeated_record_ids_are_resolved_alike_in_any_order(spark):
    u = "http://a.org/"
    rows = [full("r", u, 0, 'ETag: "one"'), full("r", u, 60, 'ETag: "two"'), full("r", u, 60, 'ETag: "three"'), full("r", "http://b.org/", 5, 'ETag: "b"'),
            again("x", u, 30, 'ETag: "one"'), again("y", u, 90, 'ETag: "three"'), again("z", "http://b.org/", 9, 'ETag: "b"')]
    for seed in range(3):
        some = rows[:]
        random.Random(seed).shuffle(some)
        got = resolved(spark, some)
        assert {k: r.status for k, r in got.items()} == {"x": "resolved", "y": "resolved", "z": "resolved"}


def test_fractions_of_a_second_are_cut(spark):
    u, at = "http://a.org/", lambda s: DAY0 + dt.timedelta(seconds=s)
    move = lambda r, s: (*r[:3], at(s), *r[4:])
    rows = [move(full("z", u, 0, 'ETag: "z"'), 0.1), move(full("a", u, 0, 'ETag: "a"'), 0.9), move(again("x", u, 0, 'ETag: "z"'), 1.2),
            move(full("n", u, 0, 'ETag: "n"'), 5.1), move(again("y", u, 0, 'ETag: "z"'), 5.9)]
    got = resolved(spark, rows)
    assert got["x"].refers_to == "z" and got["x"].status == "resolved"
    assert got["y"].refers_to == "z" and got["y"].warc_date == at(5.9)
