"""Exact deduplication against a persistent digest index.

The index is a bucketed table: one row a distinct text that was ever taken in,
with the SHA-256 of the text, the document that stands for it and the batch that
brought it, dealt into buckets by a hash of the digest and sorted by digest
within each.  A new batch is reduced to its distinct digests (copies combine
map-side), dealt the same way, and anti-joined with the index by sort-merge:
the index side is neither shuffled nor, while a bucket is one file, sorted.
What is left is appended in the same layout.  ``compact`` merges the files that
appends have left.

Only digests and ids are shuffled, never texts.  The rows of a batch meet their
group's answer in a join whose large side is split where one text holds very
many rows (no bucketed table takes part in that join).

Recovery: index rows name their batch.  A batch that stopped after its append is
given again under the same name: its own rows do not count as seen and are not
appended twice, so the answer is the same.  Batches are given one at a time.

Defined results: a null text counts as empty; of equal texts in a batch the row
with the largest doc_id stays (a null id is smaller than any); of rows with
equal doc_id and text exactly one; a text that an earlier batch brought stays
with that batch's document and all rows of the new batch go.  ``group_size``
counts the batch's rows of that text.  An empty table gives an empty result;
``deduplicate`` looks at no other columns, ``new_documents`` returns all.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fs
from ..session import conf_override
from .common import cut, text_or_empty, whole_rows, with_keys

DIGESTS_A_BUCKET = 1_000_000
LEAST_BUCKETS = 16
COLUMNS = "digest BINARY, keep_id BIGINT, batch STRING"
# A bucket that is one file comes sorted; Spark uses that only when told to look.
SORTED = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}


@dataclass(frozen=True)
class DigestIndex:
    """A bucketed table of digests under ``path``, found again by its path in any session."""

    spark: SparkSession
    path: str
    buckets: int

    @staticmethod
    def open(spark: SparkSession, path: str, buckets: int | None = None, expected: int = 0) -> "DigestIndex":
        """The index at ``path``, made if there is none: with ``buckets``, or enough for ``expected`` digests."""
        path = path.rstrip("/")
        noted = fs.read_text(spark, f"{path}/index.json")
        if noted is None:
            if buckets is None:
                buckets = LEAST_BUCKETS
                while buckets * DIGESTS_A_BUCKET < expected:
                    buckets *= 2
            fs.write_text(spark, f"{path}/index.json", json.dumps({"buckets": buckets, "rows": "rows"}))
            noted = fs.read_text(spark, f"{path}/index.json")
        index = DigestIndex(spark, path, json.loads(noted)["buckets"])
        index._register()
        return index

    @property
    def name(self) -> str:
        return "digests_" + hashlib.sha256(f"{self.path}/{self._folder()}".encode()).hexdigest()[:24]

    def _folder(self) -> str:
        return json.loads(fs.read_text(self.spark, f"{self.path}/index.json"))["rows"]

    def _register(self) -> None:
        place = f"{self.path}/{self._folder()}"
        fs.make_folder(self.spark, place)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} ({COLUMNS}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{place}'")

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def dealt(self, digests: DataFrame) -> DataFrame:
        """``digests`` in the index's own layout, so that joins with it and appends need no further shuffle."""
        return digests.repartition(self.buckets, "digest")

    def append(self, digests: DataFrame, batch: str) -> None:
        """Add the (digest, keep_id) whose digest is not there yet; ``digests`` holds each once."""
        fresh = self.dealt(digests).join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        with conf_override(self.spark, SORTED):
            fresh.select("digest", "keep_id", F.lit(batch).alias("batch")).write.insertInto(self.name)

    def compact(self) -> "DigestIndex":
        """Merge each bucket's files into one: written beside, then switched to in one step; the old folder goes."""
        old, new = self._folder(), f"rows-{hashlib.sha256(str(fs.list_files(self.spark, self.path)).encode()).hexdigest()[:16]}"
        rows = self.rows()
        beside = "digests_" + hashlib.sha256(f"{self.path}/{new}".encode()).hexdigest()[:24]
        fs.delete(self.spark, f"{self.path}/{new}")
        fs.make_folder(self.spark, f"{self.path}/{new}")
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {beside} ({COLUMNS}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{new}'")
        # A bucketed scan is a task a bucket already; Spark would else give it up and write a file for each file read.
        with conf_override(self.spark, {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):
            self.dealt(rows).write.insertInto(beside)
        fs.write_text(self.spark, f"{self.path}/index.json", json.dumps({"buckets": self.buckets, "rows": new}))
        fs.delete(self.spark, f"{self.path}/{old}")
        self._register()
        return self


def digest_of(text: Column | str) -> Column:
    """SHA-256 of the whole text, UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256))


def _decide(index: DigestIndex, rows: DataFrame, batch: str) -> DataFrame:
    """``rows`` (doc_id, key, digest; written, as they are read twice) with keep_id, group_size, kept."""
    rows = cut(rows.withColumn("uid", F.monotonically_increasing_id()), "digests")
    best = F.max(F.struct("doc_id", "key", "uid")).alias("best")
    groups = cut(rows.groupBy("digest").agg(best, F.count("*").alias("group_size")), "groups")
    index.append(groups.select("digest", F.col("best.doc_id").alias("keep_id")), batch)
    with conf_override(index.spark, SORTED):
        found = cut(index.dealt(groups).join(index.rows().hint("merge"), "digest")
                    .select("digest", "keep_id", "group_size", F.when(F.col("batch") == batch, F.col("best.uid")).alias("kept_uid")), "found")
    return rows.join(found, "digest").withColumn("kept", F.coalesce(F.col("uid") == F.col("kept_uid"), F.lit(False)))


def deduplicate(index: DigestIndex, docs: DataFrame, batch: str) -> DataFrame:
    """Take ``docs`` (doc_id, text) in as ``batch`` -> doc_id, keep_id, group_size, kept, text_sha256: a row for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("key"), digest_of("text").alias("digest"))
    return _decide(index, rows, batch).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def new_documents(index: DigestIndex, docs: DataFrame, batch: str) -> DataFrame:
    """Take ``docs`` in as ``batch`` -> those of its rows that stay, all columns."""
    rows = whole_rows(docs, F.col("doc_id"), digest_of("text").alias("digest"))
    narrow = cut(rows.select("doc_id", "key", "digest"), "keys")
    stay = _decide(index, narrow, batch).where("kept").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    return with_keys(rows.drop("digest"), stay, narrow, "left_semi").select("row.*")
