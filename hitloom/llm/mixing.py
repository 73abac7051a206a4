"""Mix sources to target weights by balanced sampling with the cube method
(Deville and Tille 2004; fast flight phase of Chauvet and Tille 2006).

A source whose target is r times its size takes every document floor(r) times
and draws the rest with inclusion probability r - floor(r).  The flight phase
moves the probabilities of a few documents at a time along the null space of
two constraints, the source's words and its number of documents, until each is
0 or 1; both totals stay as they are at every step.

Flights run in blocks of bounded size.  A block leaves at most two documents
open; those of many blocks meet in a flight of the next level, and so on, until
one block a source is left, whose last one or two documents are the landing
problem.  They land with settled documents of the source from all levels, drawn
by hash and enough to offset the open ones, however many levels there were:
swaps make up for a long document, and among a few more all choices are tried.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; rows with equal doc_id and size are interchangeable; a source
without words takes nothing; an empty table gives an empty result; other
columns are not looked at.  Draws come from a keyed hash: reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import counted_rows, cut, text_or_empty, whole_rows, with_keys

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 2048
LANDING = 10
# Settled documents for the landing: so many, and so many times the open words.
HELPERS, HELP_WORDS = 256, 8
SEED = 7
EPS = 1e-9


def words(text: Column | str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, source_size, docs, target: the budget by weight, with capped sources'
    excess given to the others by weight until no target is above its cap.

    Sources that reach their cap come first in order of size / weight; a source
    is capped if its cap is within the level that the rest of the budget gives
    to it and to those after it.  One row a source enters the window.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    rank = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    per = per.withColumn("w", F.get(F.array(*[F.lit(float(x)) for x in weights]), rank))
    everything = Window.partitionBy(F.lit(0))
    before = everything.orderBy(F.col("source_size") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("rest", F.lit(share) * F.sum("source_size").over(everything)
                          - F.lit(most) * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
           .withColumn("w_rest", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           .withColumn("level", F.col("rest") / F.col("w_rest")))
    cap = F.lit(float(most)) * F.col("source_size")
    per = per.withColumn("capped", cap <= F.col("level") * F.col("w"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    return per.select("source", "source_size", "docs",
                      F.when(F.col("capped"), cap).otherwise(level * F.col("w")).alias("target"))


def _draw(*key) -> float:
    import hashlib

    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=7).digest()) / 2.0 ** 56


def flight(sizes: list[int], chances: list[float], key: str) -> list[float]:
    """Move chances to 0 or 1, keeping sum(chance) and sum(chance * size).

    At most two stay open, fewer if what is left allows it.
    """
    p = list(chances)
    free: list[int] = []

    def step(units: list[int], move: list[float]) -> None:
        up = min(((1 - p[i]) / m if m > 0 else p[i] / -m) for i, m in zip(units, move) if m)
        down = min((p[i] / m if m > 0 else (1 - p[i]) / -m) for i, m in zip(units, move) if m)
        by = up if _draw(SEED, key, units) * (up + down) < down else -down
        for i, m in zip(units, move):
            p[i] += by * m
            p[i] = 0.0 if p[i] < EPS else 1.0 if p[i] > 1 - EPS else p[i]

    for unit in range(len(p)):
        if not 0 < p[unit] < 1:
            continue
        free.append(unit)
        if len(free) == 2 and sizes[free[0]] == sizes[free[1]]:
            step(free, [1.0, -1.0])
        elif len(free) == 3:
            # The null vector of the rows (size) and (1); it can't vanish, as
            # equal pairs were settled before.
            a, b, c = (sizes[i] for i in free)
            scale = float(max(abs(b - c), abs(c - a), abs(a - b)))
            step(free, [(b - c) / scale, (c - a) / scale, (a - b) / scale])
            free = [i for i in free if 0 < p[i] < 1]
            if len(free) == 2 and sizes[free[0]] == sizes[free[1]]:
                step(free, [1.0, -1.0])
        free = [i for i in free if 0 < p[i] < 1]
    return p


def _offset(sizes: list[int], p: list[float], settled: list[int], need: float) -> list[int]:
    """Settled documents whose change of sides adds about ``need`` words: swaps of a long
    and a short one, which keep the number of documents, then, where these do not do, single ones."""
    side = 0.0 if need > 0 else 1.0
    give = sorted((i for i in settled if p[i] == side), key=lambda i: -sizes[i])
    take = sorted((i for i in settled if p[i] != side), key=lambda i: sizes[i])
    left, out, rest, j = abs(need), [], [], 0
    for i in give:
        gain = sizes[i] - sizes[take[j]] if j < len(take) else 0
        if 0 < gain <= left:
            out += [i, take[j]]
            left, j = left - gain, j + 1
        else:
            rest.append(i)
    longest = max((sizes[i] for i in settled), default=0)
    for i in rest:
        if longest < left and sizes[i] <= left:
            out.append(i)
            left -= sizes[i]
    return out


def landing(sizes: list[int], chances: list[float], helpers: int = LANDING) -> list[float]:
    """Settle the last open documents: the choice nearest to the open words, then to the open documents.

    Settled documents may change sides with them, so that a long open document
    does not decide the total alone: for each choice those that offset it, and
    any of ``helpers`` others, spread over the sizes; among equal choices the
    one that changes the fewest wins.
    """
    p = list(chances)
    free = [i for i, x in enumerate(p) if 0 < x < 1]
    if not free:
        return p
    settled = sorted((i for i, x in enumerate(p) if x in (0.0, 1.0) and sizes[i]), key=lambda i: (-sizes[i], i))
    open_words, open_docs = sum(sizes[i] * p[i] for i in free), sum(p[i] for i in free)
    best = None
    for bits in range(1 << len(free)):
        chosen = {i: float(bits >> k & 1) for k, i in enumerate(free)}
        need = open_words - sum(sizes[i] * x for i, x in chosen.items())
        for moved in ([], _offset(sizes, p, settled, need)):
            fixed = chosen | {i: 1.0 - p[i] for i in moved}
            others = [i for i in settled if i not in fixed]
            step = max(1, -(-len(others) // helpers))
            units = others[step // 2::step][:helpers]
            flips = (np.arange(1 << len(units))[:, None] >> np.arange(len(units)) & 1).astype(float)
            signs = np.array([1 - 2 * p[i] for i in units])
            words = flips @ (signs * [sizes[i] for i in units]) + sum(sizes[i] * (1 - 2 * p[i]) for i in moved) - need
            docs = flips @ signs + sum(1 - 2 * p[i] for i in moved) + sum(chosen.values()) - open_docs
            off_words, off_docs, changed = np.abs(words).round(6), np.abs(docs).round(6), flips.sum(axis=1) + len(moved)
            at = np.lexsort((changed, off_docs, off_words))[0]
            found = (off_words[at], off_docs[at], changed[at])
            if best is None or found < best[0]:
                best = found, fixed | {i: 1.0 - p[i] for i, x in zip(units, flips[at]) if x}
    for i, x in best[1].items():
        p[i] = x
    return p


def _ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    return pdf.sort_values(["size", "unit", "doc_id", "nth"], ascending=[False, True, True, True], kind="stable", na_position="first")


def _dealt(*more) -> Column:
    """A row's hash.  Equal rows differ by their number among themselves, so they are dealt like any others."""
    return F.when(F.col("nth") == 0, F.xxhash64("unit", *more)).otherwise(F.xxhash64("unit", "nth", *more))


def _fly(rows: DataFrame) -> DataFrame:
    """One level: a flight in each (group, block)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _ordered(pdf)
        pdf["chance"] = flight(pdf["size"].tolist(), pdf["chance"].tolist(), f"{pdf['part'].iloc[0]}/{pdf['block'].iloc[0]}")
        return pdf

    return rows.groupBy("part", "block").applyInPandas(run, rows.schema)


def _land(settled: DataFrame, still_open: DataFrame, numbered: DataFrame) -> DataFrame:
    """All rows, none open: each group's open ones land with a part of its settled ones."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = _ordered(pdf)
        pdf["chance"] = landing(pdf["size"].tolist(), pdf["chance"].tolist())
        return pdf

    # Drawn by hash: a bounded number whatever the size of the group, and the same at each rerun.
    share = F.lit(HELP_WORDS) * F.col("open_words") / F.greatest(F.col("source_size"), F.lit(1)) + F.lit(HELPERS) / F.col("docs")
    asked = cut(still_open.groupBy("part").agg(F.sum("size").alias("open_words"))
                .join(numbered.select("part", "source_size", "docs"), "part").select("part", share.alias("share")), "asked")
    draw = F.pmod(_dealt(F.lit("landing")), F.lit(1_000_000)) / F.lit(1_000_000)
    marked = settled.join(asked, "part", "left").withColumn("helps", F.coalesce(draw < F.col("share"), F.lit(False)))
    columns = settled.columns
    together = marked.where("helps").select(columns).unionByName(still_open)
    landed = cut(together.groupBy("part").applyInPandas(run, settled.schema), "landing")
    return marked.where("NOT helps").select(columns).unionByName(landed)


def balanced_copies(sized: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """``sized`` (doc_id, source, size, unit) -> its columns, source_size, target, copies.

    ``unit`` is a hash of the row: it deals documents to blocks and orders ties.
    Rows equal in all four columns are counted and numbered first.
    """
    plain = sized.select("doc_id", "source", "size", "unit")
    counted, spread = counted_rows(plain)
    sized = cut(spread(counted).withColumnRenamed("_nth", "nth"), "numbered")
    per = cut(targets(sized, **options), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # A source's rows share a number; blocks follow from its count of documents.
    numbered = per.select(F.col("source").alias("_source"), "source_size", "target", "docs", F.xxhash64("source").alias("part"),
                          F.floor(ratio + F.lit(EPS)).cast("int").alias("whole"),
                          F.greatest(ratio - F.floor(ratio + F.lit(EPS)), F.lit(0.0)).alias("chance"),
                          F.ceil(F.col("docs") / F.lit(block)).cast("int").alias("blocks"))
    biggest = numbered.agg(F.max("blocks")).first()[0] or 1
    rows = (sized.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("block", F.pmod(_dealt(), F.col("blocks")).cast("int")))
    fields = ["doc_id", "source", "size", "unit", "nth", "source_size", "target", "part", "whole", "chance", "block"]
    rows, done = rows.select(*fields), []
    while True:
        rows = cut(_fly(rows), "flight")
        is_open = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(rows.where(~is_open))
        if biggest <= 1:
            break
        # At most two open documents a block: block // (size / 2) blocks meet in the next level.
        biggest = -(-biggest // (block // 2))
        rows = rows.where(is_open).withColumn("block", F.expr(f"block div {block // 2}").cast("int"))
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    out = _land(settled, rows.where(is_open), numbered)
    return out.withColumn("copies", (F.col("whole") + F.round("chance")).cast("int")).drop("part", "whole", "chance", "block", "nth")


def mix(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """``docs`` (doc_id, text, source) -> doc_id, size, source, source_size, target, copies, taken."""
    sized = cut(docs.select("doc_id", "source", words("text").alias("size"),
                            F.xxhash64("doc_id", F.md5(text_or_empty("text").cast("binary"))).alias("unit")), "sizes")
    return (balanced_copies(sized, block, **options)
            .withColumn("taken", F.col("size") * F.col("copies")))


def mixed_documents(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken.

    Rows equal in all columns share their copies: one of them carries the sum.
    """
    keyed = whole_rows(docs, "doc_id", "source", "text")
    sized = cut(keyed.select("doc_id", "source", words("text").alias("size"), F.col("key").alias("unit")), "sizes")
    copies = (balanced_copies(sized, block, **options).groupBy("doc_id", "unit").agg(F.sum("copies").alias("copies"))
              .where("copies > 0").withColumnsRenamed({"doc_id": "_id", "unit": "_key"}))
    taken = with_keys(keyed.select("row", "key", "doc_id"), copies, sized.withColumnRenamed("unit", "key"), "inner")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
