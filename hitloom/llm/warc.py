"""Resolve WARC not-modified revisits: what the page was when the server answered 304.

A revisit record is joined as of its date to the latest earlier full response
of the same canonical URL.  If the validators agree (ETag, else Last-Modified,
else payload digest), it gets that response's payload and its headers,
refreshed by those the 304 may change (RFC 9111, section 3.2).

The as-of join never sorts a whole URL in one task.  Records are first reduced
to distinct (URL, second) points, then to the last response of each (URL, day);
a window over a URL's days brings in what an earlier day left, a window within
each (URL, day) the rest.  Dates count in whole seconds (fractions are cut), so a
day has at most 86,400 such points.  Only bodies that a revisit refers to move, once.

Defined results: status ``resolved``, ``no_url`` or ``no_date`` (null or
unreadable), ``no_earlier_response`` (strictly earlier), ``no_validator`` or
``mismatch``.  Of responses in the same second the largest record_id counts; one
in the revisit's own second is not earlier; responses without record_id can't be
referred to; of responses that share record_id, URL and second the smallest by
(header, digest, carried columns) counts, one that shares the id alone is another
response; repeated revisits come back as often as they
came; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

# Fixed values (RFC 9110 and 9111): header fields that a 304 must not change,
# as they belong to the connection or describe the stored body.
NOT_MERGED = ("connection", "proxy-connection", "keep-alive", "te", "trailer", "transfer-encoding", "upgrade",
              "proxy-authenticate", "proxy-authentication-info", "proxy-authorization",
              "content-encoding", "content-length", "content-range", "content-type")
TRACKING = r"utm_[a-z]+|gclid|fbclid|msclkid"


def canonical_url(url: Column) -> Column:
    """host[:port]/path[?query] for grouping captures: without scheme, user, www, default port, fragment,
    tracking parameters and trailing slash; host in lower case, parameters sorted.  Null if unreadable."""
    form = r"^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
    host = F.lower(F.regexp_replace(F.regexp_extract(url, form, 2), r"^.*@", ""))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)?$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, form, 3), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(url, form, 4), r"^\?", "")
    fields = F.array_sort(F.filter(F.split(query, "&"), lambda f: (f != "") & ~F.lower(f).rlike(rf"^({TRACKING})(=|$)")))
    return F.when((host != "") & host.isNotNull(), F.concat(
        host, path, F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise("")))


def parse_headers(block: Column) -> Column:
    """HTTP header block -> array of (name in lower case, value), in order; the status line is left out."""
    lines = F.split(F.coalesce(block, F.lit("")), "\r?\n")
    named = F.filter(lines, lambda x: x.rlike(r"^[!#$%&'*+.^_`|~0-9A-Za-z\-]+:"))
    return F.transform(named, lambda x: F.struct(
        F.lower(F.substring_index(x, ":", 1)).alias("name"), F.trim(F.regexp_replace(x, r"^[^:]*:", "")).alias("value")))


def status_code(block: Column) -> Column:
    return F.regexp_extract(F.coalesce(block, F.lit("")), r"^HTTP/[0-9.]+ ([0-9]{3})", 1)


def header(headers: Column, name: str) -> Column:
    """The first value of a field, null if there is none."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), 0)["value"]


def merge_headers(stored: Column, fresh: Column) -> Column:
    """Stored fields, those that the 304 names and may change replaced by its own."""
    listed = F.transform(F.split(F.coalesce(header(fresh, "connection"), F.lit("")), ","), lambda x: F.lower(F.trim(x)))
    may = F.filter(fresh, lambda h: ~h["name"].isin(*NOT_MERGED) & ~F.array_contains(listed, h["name"]))
    return F.concat(F.filter(stored, lambda h: ~F.exists(may, lambda n: n["name"] == h["name"])), may)


def _as_of(full: DataFrame, asked: DataFrame) -> DataFrame:
    """(url, second) of the revisits -> found (id and second): the latest response of an earlier second."""
    points = (full.groupBy("url", "second").agg(F.max("record_id").alias("id"))
              .select("url", "second", F.struct("id", "second").alias("found"))
              .unionByName(asked.select("url", "second").distinct(), allowMissingColumns=True)
              .groupBy("url", "second").agg(F.max("found").alias("found"))
              .withColumn("day", F.to_date("second")))
    days = points.groupBy("url", "day").agg(F.max_by("found", F.when(F.col("found").isNotNull(), F.col("second"))).alias("found"))
    earlier_days = Window.partitionBy("url").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    brought = days.select("url", "day", F.last("found", ignorenulls=True).over(earlier_days).alias("brought"))
    earlier = Window.partitionBy("url", "day").orderBy("second").rowsBetween(Window.unboundedPreceding, -1)
    return (points.withColumn("same_day", F.last("found", ignorenulls=True).over(earlier))
            .join(brought, ["url", "day"])
            .select("url", "second", F.coalesce("same_day", "brought").alias("found")))


def _stored(full: DataFrame, referred: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """The responses that some revisit refers to, one for each (id, url, second): only their bodies move.

    Several under one id, URL and second are told apart by all that they hold; the smallest counts."""
    key = ["record_id", "url", "second"]
    named = full.select(*key, F.col("http_header").alias("_stored"), F.col("payload_digest").alias("_digest"), *carry)
    needed = named.join(referred.select(F.col("found.id").alias("record_id"), "_url", F.col("found.second").alias("second"))
                        .withColumnRenamed("_url", "url").distinct(), key, "left_semi")
    again = cut(full.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key), "repeated-records")
    if again.isEmpty():
        return needed
    rest = ["_stored", "_digest", *carry]
    one = needed.join(again, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*rest)).alias("x"))
    return needed.join(again, key, "left_anti").unionByName(one.select(*key, "x.*"))


def resolve_revisits(records: DataFrame, carry: tuple[str, ...] = ("payload",)) -> DataFrame:
    """``records`` (record_id, warc_type, target_uri, warc_date timestamp, http_header, payload_digest and ``carry``)
    -> one row a revisit: record_id, canonical_url, warc_date, status, refers_to, headers, ``carry``."""
    read = records.select("record_id", "warc_type", "http_header", "payload_digest", canonical_url(F.col("target_uri")).alias("url"),
                          F.col("warc_date").alias("at"), F.date_trunc("second", "warc_date").alias("second"), *carry)
    is_full = (F.col("warc_type") == "response") & status_code(F.col("http_header")).isin("200", "203")
    full = read.where(is_full & F.col("record_id").isNotNull() & F.col("url").isNotNull() & F.col("at").isNotNull())
    revisits = read.where(F.col("warc_type") == "revisit").drop(*carry)
    dated = revisits.where(F.col("url").isNotNull() & F.col("at").isNotNull())
    # What has no URL, date or earlier response joins by a key of its own, so
    # that such rows don't all go to one task.
    alone = F.concat(F.lit("none "), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    known = F.col("url").isNotNull() & F.col("at").isNotNull()
    as_of = cut(_as_of(full, dated).select(F.col("url").alias("_url"), F.col("second").alias("_second"), "found"), "as-of")
    placed = (revisits.withColumn("_key", F.when(known, F.col("url")).otherwise(alone))
              .join(as_of, (F.col("_key") == F.col("_url")) & (F.col("second") == F.col("_second")), "left")
              .withColumn("found", F.when(known, F.col("found"))).drop("_key", "_url", "_second", "second"))
    stored = _stored(full, as_of.where("found is not null"), carry).select(
        F.col("record_id").cast("string").alias("_id"), F.col("url").alias("_at_url"), F.col("second").alias("_at_second"), "_stored", "_digest", *carry)
    same = ((F.coalesce(F.col("found.id").cast("string"), alone) == F.col("_id")) & (F.col("url") == F.col("_at_url"))
            & (F.col("found.second") == F.col("_at_second")))
    joined = (placed.join(stored, same, "left").withColumn("refers_to", F.col("found.id"))
              .withColumn("_new", parse_headers(F.col("http_header"))).withColumn("_old", parse_headers(F.col("_stored"))))

    def bare(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    tag, modified = header(F.col("_new"), "etag"), header(F.col("_new"), "last-modified")
    agrees = (F.when(tag.isNotNull(), bare(tag) == bare(header(F.col("_old"), "etag")))
              .when(modified.isNotNull(), modified == header(F.col("_old"), "last-modified"))
              .otherwise(F.col("payload_digest") == F.col("_digest")))
    checked = tag.isNotNull() | modified.isNotNull() | F.col("payload_digest").isNotNull()
    status = (F.when(F.col("url").isNull(), "no_url").when(F.col("at").isNull(), "no_date")
              .when(F.col("refers_to").isNull(), "no_earlier_response").when(~checked, "no_validator")
              .when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("mismatch"))
    done = joined.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return done.select("record_id", F.col("url").alias("canonical_url"), F.col("at").alias("warc_date"), "status", "refers_to",
                       F.when(ok, merge_headers(F.col("_old"), F.col("_new"))).alias("headers"),
                       *[F.when(ok, F.col(c)).alias(c) for c in carry])


def captures_of(pages: DataFrame) -> DataFrame:
    """WARC records made of a ``pages`` table (page_id, url, html): each page is fetched once in full and asked
    for again one and two days later, some also an hour before.  Full responses carry the html as their payload."""
    digest, body = F.md5(F.coalesce("html", F.lit("")).cast("binary")), F.coalesce("html", F.lit(""))
    n = F.col("page_id")
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(n * 37, F.lit(31_536_000)))
    tag, modified = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"')), F.concat(F.lit("day-"), F.pmod(n, F.lit(28)).cast("string"))
    base = pages.select("page_id", "url", at.alias("first"), body.alias("body"),
                        F.octet_length(body.cast("binary")).cast("long").alias("bytes"), tag.alias("tag"), modified.alias("modified"))

    def lines(*parts) -> Column:
        return F.array_join(F.array(*[p if isinstance(p, Column) else F.lit(p) for p in parts]), "\r\n")

    full = lines("HTTP/1.1 200 OK", "Content-Type: text/html", F.concat(F.lit("Content-Length: "), F.col("bytes").cast("string")),
                 F.concat(F.lit("ETag: "), F.col("tag")), F.concat(F.lit("Last-Modified: "), F.col("modified")), "Cache-Control: max-age=60")
    again = lines("HTTP/1.1 304 Not Modified", F.concat(F.lit("etag: W/"), F.col("tag")), "cache-control: max-age=3600",
                  "Content-Length: 0", "Connection: close, X-Hop", "X-Hop: 1", "Age: 5")
    third = F.pmod(n, F.lit(3))
    later = (F.when(third == 0, lines("HTTP/1.1 304 Not Modified", F.concat(F.lit("Last-Modified: "), F.col("modified"))))
             .when(third == 1, lines("HTTP/1.1 304 Not Modified", 'ETag: "other"')).otherwise(lines("HTTP/1.1 304 Not Modified")))
    hour, day = F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 DAY")
    kinds = F.array(
        F.struct(F.lit("response").alias("warc_type"), F.lit("a").alias("part"), F.col("first").alias("warc_date"), full.alias("http_header")),
        F.struct(F.lit("revisit").alias("warc_type"), F.lit("b").alias("part"), (F.col("first") + day).alias("warc_date"), again.alias("http_header")),
        F.struct(F.lit("revisit").alias("warc_type"), F.lit("c").alias("part"), (F.col("first") + day + day).alias("warc_date"), later.alias("http_header")),
        F.when(F.pmod(n, F.lit(11)) == 0, F.struct(F.lit("revisit").alias("warc_type"), F.lit("d").alias("part"),
                                                   (F.col("first") - hour).alias("warc_date"), again.alias("http_header"))))
    return (base.withColumn("k", F.explode(F.array_compact(kinds)))
            .select(F.concat(F.lpad(F.col("page_id").cast("string"), 20, "0"), F.col("k.part")).alias("record_id"), "k.warc_type",
                    F.col("url").alias("target_uri"), "k.warc_date", "k.http_header", F.lit(None).cast("string").alias("payload_digest"),
                    F.when(F.col("k.warc_type") == "response", F.col("body")).alias("payload")))
