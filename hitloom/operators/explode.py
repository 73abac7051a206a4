"""Compact session table to the fully exploded table (267 columns).

One output row per combination of a hit's promotion, product, session custom
dimension, experiment, custom variable, hit custom dimension and metric, and
product custom dimension and metric.  Hits and promotions are flattened
inner (a hit without promotions vanishes), everything else outer.

Plan shape: every flatten is a ``Generate`` (narrow, no shuffle).  The
fields of an element are extracted right after its own flatten, before the
rows multiply further, so each hit's ~140 values are cast once per hit, not
once per output row; the element blobs are dropped before the final select.

A session is one row of the compact table, so a session with very many hits would
multiply in one task.  Sessions whose ``totals_hits`` is ``HEAVY_HITS`` or more are
taken apart first: their hits are dealt to all tasks by position, and multiply there.
The others keep the narrow plan.  Whether there are any is asked of one scalar
column (parquet statistics answer most of it), so a table without pays nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom import spec
from hitloom.operators.compact import grouped_extract
from hitloom.operators.flatten import elements


HEAVY_HITS = 10_000


def _elem(alias: str) -> str:
    return f"__{alias}"


def _arr(alias: str) -> str:
    return f"__arr_{alias}"


def explode_sessions(compact: DataFrame, outer_promotions: bool = False,
                     drop_unused: bool = False, strict: bool = True, heavy_hits: int = HEAVY_HITS) -> DataFrame:
    """``outer_promotions`` keeps hits without promotions; ``drop_unused``
    skips the product custom-metric flatten, which adds rows but no column.
    """
    options = (outer_promotions, drop_unused, strict)
    heavy = F.coalesce(F.col("totals_hits") >= heavy_hits, F.lit(False))
    if compact.where(heavy).select("totals_hits").isEmpty():
        return _explode(compact, *options)
    return _explode(compact.where(~heavy), *options).unionByName(_explode(compact.where(heavy), *options, deal=True))


def _explode(compact: DataFrame, outer_promotions: bool, drop_unused: bool, strict: bool, deal: bool = False) -> DataFrame:
    """The chain of flattens; ``deal`` deals a session's hits to all tasks before they multiply.

    The element arrays a flatten needs are built right after their parent
    element appears (once per hit, once per product), not at the flatten
    itself, where the rows have already been multiplied by the earlier
    flattens of sibling arrays."""
    by_element: dict[str, list[spec.Column]] = {}
    for c in spec.EXPLODED:
        if c.element:
            by_element.setdefault(c.element, []).append(c)

    chain = []
    for alias, parent, path, outer in spec.FLATTEN_CHAIN:
        if alias == "hits_promotion" and outer_promotions:
            outer = True
        if drop_unused and not by_element.get(alias):
            continue
        chain.append((alias, parent, path, outer))
    children: dict[str, list[tuple[str, str]]] = {}
    for alias, parent, path, _ in chain:
        children.setdefault(parent, []).append((alias, path))

    def with_child_arrays(df: DataFrame, parent: str) -> DataFrame:
        kids = children.get(parent, [])
        if not kids:
            return df
        if parent:
            src = F.col(_elem(parent))
            arrays = [elements(F.variant_get(src, f"$.{path}", "variant")).alias(_arr(a))
                      for a, path in kids]
        else:
            arrays = [elements(F.col(path)).alias(_arr(a)) for a, path in kids]
        return df.select("*", *arrays)

    df = with_child_arrays(compact.select(*[c.name for c in spec.COMPACT]), "")
    for alias, _parent, _path, outer in chain:
        kept = [c for c in df.columns if c != _arr(alias)]
        if deal and alias == chain[0][0]:
            gen = F.posexplode_outer if outer else F.posexplode
            tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            df = (df.select(*kept, gen(F.col(_arr(alias))).alias("__place", _elem(alias)))
                  .repartition(tasks, "fullVisitorId", "visitId", "__place").drop("__place"))
        else:
            gen = F.explode_outer if outer else F.explode
            df = df.select(*kept, gen(F.col(_arr(alias))).alias(_elem(alias)))
        fields = by_element.get(alias, [])
        if fields:
            df = grouped_extract(df, _elem(alias), fields, strict)
        df = with_child_arrays(df, alias)
    return df.select(*spec.EXPLODED_NAMES)
