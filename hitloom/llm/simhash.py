"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Distinct fingerprints are laid out in tiles by population count: the counts of
set bits in each of ``segments`` equal parts of the fingerprint.  Two
fingerprints that differ in r bits have tile coordinates at most r apart in
sum, so tile pairs farther apart than the radius are skipped, exactly.  The
pairs that are left are compared with numpy exclusive-or and bit counts.

A fingerprint lives in its own tile and visits the tiles within the radius
that come after it.  Tiles with more than ``tile_rows`` fingerprints are split
by hash (visitors go to every part), so a task holds one part and streams the
visitors past it.  Copies share a fingerprint and are compared once.

Defined results: a null or blank text has fingerprint zero, linked like any
other; rows with a null doc_id keep their fingerprint and count for no
component_id (null if the whole component has none); repeated rows come back
as often as they came; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, whole_rows, with_keys
from .components import connected_components

SHINGLE_WORDS = 3
RADIUS = 2
SEGMENTS = 8
TILE_ROWS = 16_384
HASH_SEED = 42
BLOCK = 65_536


def fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Majority vote, bit by bit, over the XXH64 hashes of a text's word shingles."""
    import xxhash

    words = (text or b"").lower().split()  # on bytes: ASCII letters and \x09-\x0D, \x20 only
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_per_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1]
    ends, digest = ends[k - 1:], xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in
                           zip(starts[at:at + BLOCK].tolist(), ends[at:at + BLOCK].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column, words_per_shingle: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64).view(np.int64))

    return prints(text.cast("binary"))


def _coordinates(fp: Column, segments: int) -> list[Column]:
    width = 64 // segments
    if segments == 1:
        return [F.bit_count(fp)]
    return [F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit((1 << width) - 1))) for i in range(segments)]


def _later_moves(segments: int, radius: int) -> list[list[int]]:
    """Steps between tiles at most ``radius`` apart, one of each opposite pair, without standing still."""
    found = {(0,) * segments}
    for _ in range(radius):
        found |= {(*m[:i], m[i] + s, *m[i + 1:]) for m in found for i in range(segments) for s in (-1, 1)}
    return [list(m) for m in sorted(found) if m > (0,) * segments]


def linked_pairs(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b): the components of all pairs
    at most ``radius`` bits apart, at most one link a fingerprint for each block compared."""
    width = 64 // segments
    base = width + 2 * radius + 1  # room for steps past either edge
    place = [base ** i for i in range(segments)]
    home = prints.select("fp", F.array(*_coordinates(F.col("fp"), segments)).alias("at"))
    code = sum((F.col("at")[i] + radius) * F.lit(p).cast("long") for i, p in enumerate(place))
    home = home.select("fp", code.cast("long").alias("tile"))
    # A step is one number to add to the code.  A step that would carry over
    # an edge reaches a tile that no fingerprint has, as the margin is the radius.
    moves = [int(np.dot(m, place)) for m in _later_moves(segments, radius)]
    large = home.groupBy("tile").agg(F.count("*").alias("n")).where(F.col("n") > tile_rows) \
        .select("tile", F.ceil(F.col("n") / F.lit(tile_rows)).cast("int").alias("parts"))
    large = cut(large, "large-tiles")
    stay = (home.join(large, "tile", "left")
            .withColumn("part", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int"))
            .select("tile", "part", "fp"))
    residents = stay.withColumn("visit", F.lit(False))
    going = home.select("fp", F.explode(F.array(*[F.col("tile") + F.lit(m) for m in moves])).alias("tile"))
    # Parts of a split tile are also compared with each other: its fingerprints visit the later parts.
    within = (home.join(large, "tile").select("fp", "tile", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("own"), "parts")
              .where("own + 1 < parts").select("tile", F.explode(F.sequence(F.col("own") + 1, F.col("parts") - 1)).alias("part"), "fp"))
    visitors = (going.join(large, "tile", "left")
                .select("tile", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"), "fp")
                .unionByName(within).withColumn("visit", F.lit(True)))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, key = np.empty(0, np.uint64), None  # the residents of the tile that is being read
        for rows in batches:
            fps = rows["fp"].to_numpy().astype(np.int64).view(np.uint64)
            tile, part, visit = rows["tile"].to_numpy(), rows["part"].to_numpy(), rows["visit"].to_numpy(bool)
            edges = np.flatnonzero((np.diff(tile) != 0) | (np.diff(part) != 0)) + 1
            out = []
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(fps)]):
                if lo == hi:
                    continue
                if key != (tile[lo], part[lo]):
                    held, key = np.empty(0, np.uint64), (tile[lo], part[lo])
                new = int((~visit[lo:hi]).sum())  # residents come first
                if new:
                    held = np.concatenate((held, fps[lo:lo + new]))
                if len(held) == 0 or (len(held) == 1 and hi - lo == new):
                    continue
                out += _links(held, fps[lo:hi], radius)
            if out:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
                yield pd.DataFrame({"a": a, "b": b})

    dealt = residents.unionByName(visitors).repartition("tile", "part").sortWithinPartitions("tile", "part", "visit")
    return dealt.mapInPandas(compare, "a long, b long")


def _links(held: np.ndarray, coming: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links between the residents and the rows that come (residents themselves or visitors)."""
    out, step = [], max(1, 4_194_304 // len(held))
    for at in range(0, len(coming), step):
        block = coming[at:at + step]
        i, j = np.nonzero(np.bitwise_count(block[:, None] ^ held[None, :]) <= radius)
        a, b = block[i], held[j]
        apart = a != b
        if apart.any():
            out.append(_spanning(a[apart], b[apart]))
    return out


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with at most one link a node."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    if len(a) < len(nodes):
        return a, b
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words_per_shingle: int = SHINGLE_WORDS,
                    segments: int = SEGMENTS, tile_rows: int = TILE_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, fingerprint, component_id, fp and the columns ``keep``."""
    marked = cut(docs.select("doc_id", *keep, fingerprint_column(F.col("text"), words_per_shingle).alias("fp")), "prints")
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = connected_components(linked_pairs(nodes, radius, segments, tile_rows))
    rooted = (nodes.join(roots, nodes.fp == roots.node, "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = cut(rooted.join(named, "root").select("fp", "root", "component_id"), "labels")
    return (marked.join(labels, "fp")
            .withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
            .select("doc_id", "fingerprint", "component_id", "root", *keep))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each group: the smallest doc_id (a null doc_id only where
    the group has no other), among equal doc_ids the smallest row hash."""
    keyed = whole_rows(docs, "doc_id", "text")
    found = cut(near_duplicates(keyed, keep=("key",), **options), "groups")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    stay = found.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    return with_keys(keyed, stay, found, "left_semi").select("row.*")
