"""Shards by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a uniform number u drawn from its MD5; the key goes
to the shard with the largest -weight / ln(u).  A shard's share of the keys is
its share of the weights, and the numbers of the other shards do not change
when one is added, removed or reweighted: a new shard only takes keys into
itself, a removed one only gives its own away.

All of it is DataFrame functions; a row's shard depends on its key alone, so no
shuffle is needed to place it.  Slots are numbered in hash buckets of each
shard, see ``rank_within``.

Defined results: null keys share one key (all go to the same shard); a null
text has size 1 and the checksum of nothing; repeated rows go to the same shard
and get slots of their own; an empty table gives an empty result; other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import rank_within, text_or_empty

SHARDS = 16
KEY_BITS = 52  # hex digits of the MD5 that make u: 13, which a double holds exactly


def shard_score(key: Column, shard: int, weight: float) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f"@{shard}")).cast("binary")), 1, KEY_BITS // 4)
    u = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2 ** KEY_BITS))
    return F.lit(-float(weight)) / F.ln(u)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard number of a key (any type), equal scores to the smaller number; weights of 0 or less get nothing."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    pairs = [F.struct(shard_score(text, i, w).alias("score"), F.lit(-i).alias("shard"))
             for i, w in enumerate(weights) if w > 0]
    if not pairs:
        raise ValueError("no shard has a weight above 0")
    return (-F.array_max(F.array(*pairs))["shard"]).cast("int")


def shard_documents(docs: DataFrame, weights: list[float] | None = None, extra_weight: float = 1.0) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, size, text_crc32, law, shard, slot, grown_shard
    (its shard once one more, of ``extra_weight``, is added)."""
    weights = weights or [1.0] * SHARDS
    text = text_or_empty("text").cast("binary")
    placed = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"), rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, extra_weight]).alias("grown_shard"))
    # MD5 of the id deals the buckets, so that SQL elsewhere can follow it.
    return rank_within(placed, ["shard"], ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
