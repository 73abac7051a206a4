"""Pieces that several operators share: table reading, staged tables, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..fs import delete_at_end
from ..session import work_dir
from ..sources.tables import table

__all__ = ["table", "cut", "delete_at_end", "whole_rows", "with_keys", "text_or_empty", "word_array", "counted_rows", "rank_within", "WHITE_SPACE"]

# Fixed value: the characters \x20 and \x09-\x0D separate words.
WHITE_SPACE = " \t\n\x0b\x0c\r"
COPIES_A_TASK = 100_000


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back.

    Cuts the lineage (a lost executor re-reads a file instead of repeating the
    work), lets later steps read single columns, and gives Catalyst the true
    size of small tables.  The folder goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def _shape(value: Column, kind: DataType) -> list[Column]:
    """What Spark's hash leaves out: which values are null, and how long arrays are, at every depth."""
    out = [value.isNull()]
    if isinstance(kind, StructType):
        for field in kind.fields:
            out += _shape(value.getField(field.name), field.dataType)
    elif isinstance(kind, ArrayType):
        out += [F.size(value), F.transform(value, lambda x: F.struct(*_shape(x, kind.elementType)))]
    return out


def _unhashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    return isinstance(kind, (MapType, VariantType)) or isinstance(kind, ArrayType) and _unhashable(kind.elementType)


def whole_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """``row`` (all columns in one struct, so that no name clashes), ``key`` (a 64-bit hash of
    the row and of where it has nulls: tells rows apart whose doc_id repeats or is null) and ``columns``."""
    own = [F.col(f"`{c}`") for c in docs.columns]
    # Maps and variants can't be hashed: columns that hold any count as their JSON text.
    text = [F.to_json(F.struct(c)) if _unhashable(f.dataType) else c for c, f in zip(own, docs.schema.fields)]
    shape = [x for c, f in zip(own, docs.schema.fields) for x in ([c.isNull()] if _unhashable(f.dataType) else _shape(c, f.dataType))]
    return docs.select(F.struct(*own).alias("row"), F.xxhash64(*text, *shape).alias("key"), *columns)


def with_keys(rows: DataFrame, keys: DataFrame, narrow: DataFrame, how: str) -> DataFrame:
    """Join ``whole_rows`` with a narrow table (_id, _key, ...) that has a row for each kept one.

    The hint keeps the wide side unsorted: it is dealt once by key and streams
    past a hash table of its partition's keys.  Rows equal in all columns are
    left once; ``narrow`` (doc_id, key of every row) tells whether there are
    any, and only they are looked at twice.
    """
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    repeats = cut(narrow.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeats")
    if not repeats.isEmpty():
        rows = (rows.join(repeats, "key", "left_anti")
                .unionByName(rows.join(repeats, "key", "left_semi").dropDuplicates(["key", "doc_id"])))
    return rows.join(keys.hint("shuffle_hash"), same, how)


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text, in order."""
    flat = F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE))
    return F.filter(F.split(flat, " "), lambda w: w != F.lit(""))


def counted_rows(df: DataFrame, piece: int = COPIES_A_TASK) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Distinct rows with their count ``_copies`` (combined map-side, so copies never meet in one
    task), and what turns rows with that column back into as many, numbered ``_nth`` from 0.

    A row with very many copies is first dealt to tasks in pieces of ``piece``."""
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("_copies"))

    def spread(rows: DataFrame) -> DataFrame:
        pieces = rows.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / piece).cast("int"))))
        # A number of tasks is named, as Spark would else merge these few rows before they multiply.
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        large = pieces.where(F.col("_copies") > piece).repartition(tasks, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], "_piece"))
        last = F.least(F.col("_copies"), (F.col("_piece") + 1).cast("long") * piece) - 1
        return (pieces.where(F.col("_copies") <= piece).unionByName(large)
                .withColumn("_nth", F.explode(F.sequence(F.col("_piece").cast("long") * piece, last))).drop("_piece", "_copies"))

    return counted, spread


def rank_within(df: DataFrame, group: list[str], order: list[str], out: str, buckets: int = 4096) -> DataFrame:
    """Number the rows of each group gapless from 0 without sorting a group in one task.

    Rows are dealt into ``buckets`` by a hash of ``order``; each (group,
    bucket) is numbered on its own and starts where the counts of the group's
    smaller buckets end.  The window over buckets sees at most ``buckets``
    rows a group.  Rows equal in all columns are one row with a count until they
    have their numbers, so copies of one row are no hot bucket.
    """
    from pyspark.sql import Window

    counted, spread = counted_rows(df)
    dealt = counted.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*group, "_bucket").agg(F.sum("_copies").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    others = [c for c in df.columns if c not in order]
    within = Window.partitionBy(*group, "_bucket").orderBy(*order, *others).rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.withColumn("_rank", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
             .join(starts, [*group, "_bucket"]).withColumn("_first", F.col("_start") + F.col("_rank")))
    return (spread(first.select(*df.columns, "_copies", "_first"))
            .withColumn(out, (F.col("_first") + F.col("_nth")).cast("long")).drop("_first", "_nth"))
