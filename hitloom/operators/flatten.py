"""Lateral flatten of a variant array (or object) into one row per element.

Inner flatten drops the parent row when there is nothing to expand (the
value is missing, JSON null, empty, or a scalar); outer flatten keeps it with
a NULL element.  An object is flattened into its field values (in key order).

Each flatten is an ``explode`` ``Generate`` over the element array: narrow,
no shuffle, and whole-stage code generation runs a chain of them as one
pipeline, so the (wide) parent columns are not copied once per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elements(value: Column) -> Column:
    """ARRAY<VARIANT> of the elements of a variant array or object; NULL for
    anything else."""
    arr = F.try_variant_get(value, "$", "array<variant>")
    obj = F.map_values(F.try_variant_get(value, "$", "map<string,variant>"))
    return F.coalesce(arr, obj)


def flatten(df: DataFrame, source: str, alias: str, path: str = "$", outer: bool = False,
            with_index: bool = False) -> DataFrame:
    """Add column ``alias`` holding each element of ``source:path``.

    ``source`` is a variant column of ``df`` (a document or an element of an
    earlier flatten, so flattens nest).  ``with_index`` also adds
    ``<alias>_index`` (0-based position).
    """
    value = F.col(source) if path == "$" else F.variant_get(F.col(source), path, "variant")
    arr = elements(value)
    if with_index:
        gen = (F.posexplode_outer if outer else F.posexplode)(arr).alias(f"{alias}_index", alias)
    else:
        gen = (F.explode_outer if outer else F.explode)(arr).alias(alias)
    return df.select("*", gen)
