"""Exact top-k inner-product search by vector-approximation files (Weber, Schek, Blott 1998).

Every vector is approximated by a byte a component, with a cell width of its own
(the least power of two that lets its largest component fit).  The cells bound a
score from both sides; where the width is one unit they are the vector itself.

The stated queries meet the approximations of all rows in a grid of (row block,
query block): rows are dealt to row blocks and copied to each query block as bytes,
queries the other way round.  Both kinds of block have a bounded expected size.  A
pair of blocks gives, for each query, the rows that may be among its best ``k``
there; the kth largest lower bound over all blocks then rules out most of them.
Exact vectors are read by a join, best bound first: those of each query's first
``k`` candidates, and then of the ones whose bound still reaches the kth exact
score, after which the result is certain.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part; a row with a null id takes none either; rows of the
same id count as one (the smallest vector); shorter vectors end in zeros; fewer
than k candidates are all returned; an empty table gives an empty result;
other columns are not looked at.  Scores are exact; one beyond a long counts as
the nearest long.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .negatives import exact_scores

TOP = 5
QUERY_EVERY = 50
SCALE = 256
ROW_BLOCK = 32_768
QUERY_BLOCK = 4_096
LARGEST = sys.float_info.max


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, embedding -> vec_id, v array<double>: floor(scale * x) of every usable vector, one row an id."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = (F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
              & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    large = F.transform(x, lambda c: F.least(F.greatest(c * F.lit(float(scale)), F.lit(-LARGEST)), F.lit(LARGEST)))
    v = F.transform(large, lambda c: c - F.pmod(c, F.lit(1.0)))  # floor() would give a long
    return (rows.where(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def matrix(vectors: pd.Series, dims: int | None = None) -> np.ndarray:
    """Vectors below each other, filled up with zeros."""
    dims = max(map(len, vectors), default=0) if dims is None else dims
    if all(len(v) == dims for v in vectors):
        return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, dims))
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def approximate(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells (int8) and for each row the binary logarithm of its cell width."""
    most = np.abs(vectors).max(axis=1, initial=0)
    bits = np.maximum(np.frexp(most)[1] - 7, 0)  # most < 2 ** (bits + 7)
    return np.floor(np.ldexp(vectors, -bits[:, None])).clip(-128, 127).astype(np.int8), bits


def candidates(ids: np.ndarray, cells: np.ndarray, bits: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
               k: int = TOP) -> Iterator[tuple[int, int, float, float]]:
    """The rows of one block that may be among a query's best ``k``: (query_id, vec_id, upper bound, lower bound)."""
    dims = max(cells.shape[1], queries.shape[1])
    cells, queries = (np.pad(m, ((0, 0), (0, dims - m.shape[1]))) for m in (cells, queries))
    order = np.argsort(ids)
    ids, cells, bits = ids[order], cells[order], bits[order]
    # A cell holds the whole numbers from cell * width to (cell + 1) * width - 1.
    width = np.ldexp(1.0, bits)
    middle, reach = (cells + 0.5) * width[:, None] - 0.5, (width - 1) / 2
    largest = np.abs(middle).max(axis=1, initial=0)
    for at in range(0, len(queries), 64):
        some = queries[at:at + 64]
        weight = np.abs(some).sum(axis=1)
        with np.errstate(over="ignore", invalid="ignore"):
            guess = some @ middle.T
            off = weight[:, None] * reach[None, :]
            rough = weight[:, None] * (largest + 1)[None, :]
            off += np.where((rough < 2.0 ** 52) & (reach == 0)[None, :], 0.0, 1e-9 * rough)  # whole sums in 53 bits are exact
            upper, lower = guess + off, guess - off
        unknown = ~(np.isfinite(upper) & np.isfinite(lower))  # beyond the doubles: nothing is ruled out
        upper[unknown], lower[unknown] = np.inf, -np.inf
        upper, lower = upper.clip(-2.0 ** 63, 2.0 ** 63), lower.clip(-2.0 ** 63, 2.0 ** 63)  # as the scores are
        for q, high, low in zip(query_ids[at:at + 64], upper, lower):
            other = ids != q
            here, high, low = ids[other], high[other], low[other]
            if len(here) > k:
                least = np.partition(low, len(low) - k)[len(low) - k]
                # The k rows with the largest lower bounds come before any row whose upper bound is
                # smaller, or equal and its id larger than theirs.
                sure = np.flatnonzero(low >= least)
                sure = sure[np.lexsort((here[sure], -low[sure]))][:k]
                keep = (high > least) | ((high == least) & (here <= here[sure[-1]]))
                here, high, low = here[keep], high[keep], low[keep]
            yield from zip([int(q)] * len(here), here.tolist(), high.tolist(), low.tolist())


def _scored(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pairs`` (query_id, vec_id) with the exact score."""
    @F.pandas_udf("long")
    def score(v: pd.Series, q: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        for i, (a, b) in enumerate(zip(v, q)):
            n = min(len(a), len(b))
            out[i] = exact_scores(np.array([a[:n]], np.float64), np.array([b[:n]], np.float64))[0, 0]
        return pd.Series(out)

    asks = vectors.select(F.col("vec_id").alias("query_id"), F.col("v").alias("_q"))
    return pairs.join(vectors, "vec_id").join(asks, "query_id").select("query_id", "vec_id", score("v", "_q").alias("score"))


def exact_top_k(rows: DataFrame, is_query: Column, k: int = TOP, scale: int = SCALE,
                row_block: int = ROW_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``rows`` (vec_id, embedding) -> query_id, rank, vec_id, score: for every row with
    ``is_query`` its ``k`` best other rows, ties to the smaller vec_id."""
    vectors = cut(whole_vectors(rows, scale), "vectors")
    total, asked = vectors.agg(F.count("*"), F.count_if(is_query)).first()
    row_blocks, query_blocks = max(1, -(-total // row_block)), max(1, -(-asked // query_block))
    deal = F.xxhash64("vec_id")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cells, bits = approximate(matrix(batch["v"]))
                sizes = batch["v"].map(len)
                yield pd.DataFrame({"vec_id": batch["vec_id"], "bits": bits.astype(np.int32),
                                    "cells": [c[:n].tobytes() for c, n in zip(cells, sizes)]})

    nothing = F.lit(None)
    here = vectors.mapInPandas(pack, "vec_id long, bits int, cells binary").select(
        "vec_id", "bits", "cells", nothing.cast("array<double>").alias("v"), F.pmod(deal, F.lit(row_blocks)).cast("int").alias("r"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"), F.lit(False).alias("asks"))
    asking = vectors.where(is_query).select(
        "vec_id", nothing.cast("int").alias("bits"), nothing.cast("binary").alias("cells"), "v",
        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("r"),
        F.pmod(deal, F.lit(query_blocks)).cast("int").alias("q"), F.lit(True).alias("asks"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, index = None, [], None
        for batch in batches:
            for key, part in batch.groupby(["r", "q"], sort=False):
                if key != block:
                    block, held, index = key, [], None
                plain = part[~part["asks"].astype(bool)]
                if len(plain):
                    held.append(plain)
                asks = part[part["asks"].astype(bool)]
                if not len(asks) or not held:
                    continue
                if index is None:
                    own = pd.concat(held)
                    cells = matrix(own["cells"].map(lambda c: np.frombuffer(c, np.int8))).astype(np.int8)
                    index = own["vec_id"].to_numpy(np.int64), cells, own["bits"].to_numpy(np.int64)
                found = list(candidates(*index, asks["vec_id"].to_numpy(np.int64), matrix(asks["v"]), k))
                if found:
                    yield pd.DataFrame(found, columns=["query_id", "vec_id", "upper", "lower"])

    grid = here.unionByName(asking).repartition("r", "q").sortWithinPartitions("r", "q", "asks")
    found = cut(grid.mapInPandas(scan, "query_id long, vec_id long, upper double, lower double"), "candidates")

    def first(df: DataFrame, *order: Column | str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
        return df.withColumn("place", place).where(F.col("place") <= k)

    def within(df: DataFrame, best: DataFrame, value: str) -> DataFrame:
        """Candidates that the kth of ``best`` does not rule out (with fewer than k, none is)."""
        last = best.where(F.col("place") == k).select("query_id", F.col(value).alias("_least"), F.col("vec_id").alias("_last"))
        stays = F.col("_least").isNull() | (F.col("upper") > F.col("_least")) | ((F.col("upper") == F.col("_least")) & (F.col("vec_id") <= F.col("_last")))
        return df.join(last, "query_id", "left").where(stays).drop("_least", "_last")

    likely = cut(within(found, first(found, F.col("lower").desc(), "vec_id"), "lower"), "likely")
    ahead = first(likely, F.col("upper").desc(), "vec_id").select("query_id", "vec_id")
    sure = cut(_scored(ahead, vectors), "first-scores")
    rest = within(likely.join(sure, ["query_id", "vec_id"], "left_anti"), first(sure, F.col("score").desc(), "vec_id"), "score")
    scores = sure.unionByName(_scored(rest.select("query_id", "vec_id"), vectors))
    return (first(scores, F.col("score").desc(), "vec_id")
            .select("query_id", F.col("place").alias("rank"), "vec_id", "score"))
