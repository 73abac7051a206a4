"""Positions of rows in a total order, without one task holding all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hitloom import fs
from hitloom.operators.upsert import stage

_IN_PARTITION_BITS = 33  # of monotonically_increasing_id: partition above, row within it below


def numbered(df: DataFrame, *order: Column, name: str = "pos") -> DataFrame:
    """``df`` with its position (1, 2, ...) under ``order``.

    Rows are range-sorted and staged with partition and place; a partition's
    first position follows from the row counts of those before it, one row a
    partition.  Rows that tie take any order among themselves."""
    created: list[str] = []
    placed = stage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordered", created)
    for path in created:
        fs.delete_at_end(df.sparkSession, path)
    part = F.shiftright("_id", _IN_PARTITION_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    place = F.col("_id").bitwiseAND(F.lit((1 << _IN_PARTITION_BITS) - 1))
    return (placed.withColumn("_part", part).join(starts, "_part")
            .withColumn(name, F.col("_start") + place + 1).drop("_id", "_part", "_start"))
