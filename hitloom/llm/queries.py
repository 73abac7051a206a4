"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import exact_dedup, licenses, mixing, negatives, packing, pii, quality, rules, sharding, simhash, spelling, vafile, warc
from .common import delete_at_end, table


def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures made of ``pages``; headers as text, "name: value" joined by newlines; dates in seconds."""
    records = warc.captures_of(table(spark, sf_dir, "pages"))
    found = warc.resolve_revisits(records)
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    body = F.col("payload").cast("binary")
    found = found.withColumns({"payload_md5": F.md5(body), "payload_bytes": F.octet_length(body).cast("long")})
    return (found.withColumn("headers", lines).withColumn("captured", F.unix_timestamp("warc_date")).drop("warc_date")
            .select("record_id", "canonical_url", "captured", "status", "refers_to", "headers", "payload_md5", "payload_bytes"))


def op3_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are sources, their paths the source's languages."""
    return quality.site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % vafile.QUERY_EVERY == 0)


def op6_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


def op9_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source", "source_size", "target", "taken")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id 100 divides; every seventh row carries the next label."""
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    relabelled = F.when(vec_id % negatives.RELABEL_EVERY == 0, (label + 1) % negatives.LABELS).otherwise(label)
    found = negatives.hard_negatives(table(spark, sf_dir, "embeddings"), relabelled, vec_id % negatives.ANCHOR_EVERY == 0)
    return found.drop("slot")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as the first batch of a new index: the rows that stay are the ones that the index then names."""
    docs = table(spark, sf_dir, "documents")
    path = f"{work_dir(spark)}/llm/digest-index-{uuid.uuid4().hex}"
    delete_at_end(spark, path)
    return exact_dedup.deduplicate(exact_dedup.DigestIndex.open(spark, path, expected=docs.count()), docs, "documents")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_simhash_groups, op2_warc_revisits, op3_site_quality, op4_quality_rules, op5_exact_top_k, op6_rendezvous_shards,
    op7_pseudonyms, op8_license_scan, op9_power_of_two_packing, op10_cube_mix, op11_hard_negatives, op12_exact_dedup,
    op13_spelling_variants)}
