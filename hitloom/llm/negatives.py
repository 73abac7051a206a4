"""Hard negatives by slot-decomposed selection.

Every positive of an anchor opens a window of scores: its negatives lie between
a lower and an upper share of the positive's own score, so the windows of one
anchor overlap.  The positives' upper limits split the scores into disjoint
slots.  One pass over all rows puts each row of another label into its slot and
keeps the best ``k`` of every slot (a combiner: per task first, then over all).
As the slots are disjoint and in order, a window's answer is a merge of the
slots from its own upper limit downwards, and each slot's list is shared by all
windows that reach it: no window is searched by itself.

The anchors meet all rows in a grid of (row band, anchor block): anchors are
copied to every band, rows to every anchor block.  A task holds one anchor
block, streams the rows of its band past it and emits at most ``k`` rows a slot
once, whatever the band's size.  Every row that arrives costs a product with
each of the block's anchors (a thousand times its bytes), so the copies are not
what the job costs; vectors travel as they are stored.

Scores are exact integers.  Products are taken in doubles where every partial
sum fits 53 bits, else in Python's integers; a score beyond a long counts as the
nearest long.

Defined results: rows whose id, label or vector is null or whose vector holds a
null or non-finite component take no part; shorter vectors end in zeros (an
empty one scores 0 with all); rows of the same id count as one, the smallest by
(label, vector); ties go to the smaller vec_id; an anchor without other rows of
its label has no positives and no result; a positive below zero has an empty
window; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
ANCHOR_BLOCK = 4_096
ROW_BAND = 262_144
LONG = 2 ** 63


def usable_rows(rows: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, embedding of the rows that take part, one row an id."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    good = F.coalesce(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & finite, F.lit(False))
    some = rows.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
    again = cut(some.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id"), "repeated-ids")
    if again.isEmpty():
        return some
    one = some.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("x"))
    return some.join(again, "vec_id", "left_anti").unionByName(one.select("vec_id", "x.*"))


def _matrix(vectors: pa.ListArray, dims: int, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, cut or filled up with zeros to ``dims`` columns."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(lengths) and (lengths == dims).all():
        out = flat.reshape(len(lengths), dims)
    else:
        out = np.zeros((len(lengths), dims))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
        for i, (at, n) in enumerate(zip(starts, np.minimum(lengths, dims))):
            out[i, :n] = flat[at:at + n]
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(scale * out), posinf=np.finfo(np.float64).max, neginf=np.finfo(np.float64).min)


def exact_scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products of whole-number matrices (rows x anchors) as longs; beyond a long, the nearest one."""
    most = float(np.sqrt(2.0 ** 53 / max(1, rows.shape[1])))  # two components below this: every partial sum fits 53 bits
    wide_rows, wide_anchors = (np.flatnonzero(np.abs(m).max(axis=1, initial=0) > most) for m in (rows, anchors))
    if not len(wide_rows) and not len(wide_anchors):
        return (rows @ anchors.T).astype(np.int64)
    small = lambda m, wide: np.where(np.isin(np.arange(len(m)), wide)[:, None], 0.0, m)
    out = (small(rows, wide_rows) @ small(anchors, wide_anchors).T).astype(np.int64)

    def whole(m: np.ndarray) -> np.ndarray:
        return np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)

    def held(m: np.ndarray) -> np.ndarray:
        return np.array([[min(max(x, -LONG), LONG - 1) for x in row] for row in m], np.int64).reshape(m.shape)

    out[wide_rows] = held(whole(rows[wide_rows]) @ whole(anchors).T)
    out[:, wide_anchors] = held(whole(rows) @ whole(anchors[wide_anchors]).T)
    return out


class Slots:
    """The best ``k`` (score, vec_id) of each slot of each anchor seen so far."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, limits: list[np.ndarray], least: np.ndarray, same: bool, k: int):
        self.ids, self.labels, self.vectors, self.limits, self.least, self.same, self.k = ids, labels, vectors, limits, least, same, k
        self.best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def see(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, labels, vectors = ids[order], labels[order], vectors[order]
        for label in np.unique(self.labels):
            mine = np.flatnonzero(self.labels == label)
            wanted = (labels == label) == self.same
            if wanted.any():
                for at in range(0, len(mine), 256):
                    some = mine[at:at + 256]
                    scores = np.ascontiguousarray(exact_scores(vectors[wanted], self.vectors[some]).T)
                    for a, row in zip(some, scores):
                        self._add(int(a), row, ids[wanted])

    def _add(self, a: int, scores: np.ndarray, ids: np.ndarray) -> None:
        limits = self.limits[a]
        ok = (scores <= limits[0]) & (scores >= self.least[a])
        if self.same:
            ok &= ids != self.ids[a]
        scores, ids = scores[ok], ids[ok]
        # Limits fall; slot j holds the scores up to limit j and above limit j + 1.
        slot = np.searchsorted(~limits, ~scores, side="right") - 1
        for j in range(len(limits)):
            here = slot == j
            if here.any():
                s, i = scores[here], ids[here]
                if (a, j) in self.best:
                    s, i = np.concatenate([self.best[a, j][0], s]), np.concatenate([self.best[a, j][1], i])
                if len(s) > self.k:
                    near = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
                    s, i = s[near], i[near]
                first = np.lexsort((i, ~s))[:self.k]  # ~ turns the order round, also for the least long
                self.best[a, j] = s[first], i[first]

    def rows(self) -> pa.RecordBatch | None:
        if not self.best:
            return None
        keys = list(self.best)
        lengths = [len(self.best[x][0]) for x in keys]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat([self.ids[a] for a, _ in keys], lengths), pa.int64()),
            pa.array(np.repeat([j for _, j in keys], lengths), pa.int32()),
            pa.array(np.concatenate([self.best[x][1] for x in keys]), pa.int64()),
            pa.array(np.concatenate([self.best[x][0] for x in keys]), pa.int64())], names=["anchor_id", "slot", "vec_id", "score"])


def best_per_slot(rows: DataFrame, anchors: DataFrame, same: bool, k: int, scale: int = SCALE,
                  anchor_block: int = ANCHOR_BLOCK, row_band: int = ROW_BAND) -> DataFrame:
    """``rows`` (vec_id, label, embedding) against ``anchors`` (the same, limits array<bigint> falling,
    least bigint) -> anchor_id, slot, vec_id, score: of the rows of the same or of another label, the
    best ``k`` of each slot; slot j reaches from limits[j] down to above limits[j + 1], the last to least."""
    spark = rows.sparkSession
    asked, total = anchors.count(), rows.count()
    blocks = max(1, -(-asked // anchor_block))
    bands = max(1, -(-total // row_band), -(-2 * spark.sparkContext.defaultParallelism // blocks))
    deal = F.xxhash64("vec_id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("bigint")
    held = anchors.select("vec_id", "label", "embedding", "limits", "least", every(bands).alias("band"),
                          F.pmod(deal, F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("part"))
    past = rows.select("vec_id", "label", "embedding", F.array(none).alias("limits"), none.alias("least"),
                       F.pmod(deal, F.lit(bands)).cast("int").alias("band"), every(blocks).alias("block"), F.lit(1).alias("part"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, slots, dims = None, [], None, 0
        for batch in batches:
            band, block, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("band", "block", "part"))
            edges = np.flatnonzero(np.diff(band) | np.diff(block) | np.diff(part)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(band)]):
                piece, here = batch.slice(lo, hi - lo), (band[lo], block[lo])
                if here != cell:
                    if slots is not None and (out := slots.rows()) is not None:
                        yield out
                    cell, waiting, slots = here, [], None
                if part[lo] == 0:
                    waiting.append(piece)
                    continue
                if slots is None:
                    if not waiting:
                        continue
                    own = pa.Table.from_batches(waiting).combine_chunks()
                    vectors = own.column("embedding").combine_chunks()
                    dims = max(1, pc.max(pc.list_value_length(vectors)).as_py())
                    slots = Slots(own.column("vec_id").to_numpy(), own.column("label").to_numpy(), _matrix(vectors, dims, scale),
                                  [np.array(x, np.int64) for x in own.column("limits").to_pylist()], own.column("least").to_numpy(), same, k)
                slots.see(piece.column("vec_id").to_numpy(), piece.column("label").to_numpy(), _matrix(piece.column("embedding"), dims, scale))
        if slots is not None and (out := slots.rows()) is not None:
            yield out

    grid = held.unionByName(past).repartition("band", "block").sortWithinPartitions("band", "block", "part")
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.col("score").desc(), "vec_id")
    return (grid.mapInArrow(scan, "anchor_id long, slot int, vec_id long, score long")
            .withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place"))


def hard_negatives(rows: DataFrame, label: Column | str, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least_percent: int = LEAST_PERCENT, most_percent: int = MOST_PERCENT, scale: int = SCALE,
                   anchor_block: int = ANCHOR_BLOCK, row_band: int = ROW_BAND) -> DataFrame:
    """``rows`` (vec_id, embedding and what ``label`` names) -> anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score, slot: for each row with ``is_anchor`` and each of its best
    ``positives`` of its own label, the first ``negatives`` rows of another label whose score lies
    between the two shares of the positive's."""
    size = dict(scale=scale, anchor_block=anchor_block, row_band=row_band)
    whole = usable_rows(rows, F.col(label) if isinstance(label, str) else label)
    anchors = cut(whole.where(F.coalesce(is_anchor, F.lit(False))), "anchors")
    top, low = F.lit(LONG - 1).cast("long"), F.lit(-LONG).cast("long")
    near = best_per_slot(whole, anchors.select("*", F.array(top).alias("limits"), low.alias("least")), True, positives, **size)
    share = lambda percent: F.col("score").cast("decimal(20,0)") * percent / 100
    windows = cut(near.select(F.col("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
                              F.floor(share(most_percent)).cast("long").alias("most"), F.ceil(share(least_percent)).cast("long").alias("least"))
                  .where("least <= most"), "windows")
    limits = windows.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.sort_array(F.collect_set("most"), asc=False).alias("limits"), F.min("least").alias("least"))
    slots = cut(best_per_slot(whole, anchors.join(limits, "vec_id"), False, negatives, **size), "slots")
    # One list an anchor, at most ``negatives`` a slot and ``positives`` slots: best first, so slot after slot.
    merged = slots.groupBy("anchor_id").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score").cast("decimal(20,0)")).alias("order"), "vec_id", "score", "slot"))).alias("rows"))
    # From a window's own slot downwards, as far as its lower limit.
    answer = F.slice(F.filter("rows", lambda r: (r["score"] <= F.col("most")) & (r["score"] >= F.col("least"))), 1, negatives)
    return (windows.join(merged, "anchor_id")
            .select("anchor_id", "positive_id", "positive_score", F.posexplode(answer).alias("pos", "r"))
            .select("anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("negative_id"),
                    "positive_score", F.col("r.score").alias("negative_score"), F.col("r.slot").alias("slot")))
