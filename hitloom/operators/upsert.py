"""Keyed upsert of a batch into a parquet session table.

Semantics: rows of the batch whose key matches a table row replace it
("update all non-key columns" leaves nothing of the old row), the others are
inserted.  The default key contains the content hash, so a match means equal
content and the update rewrites equal values: that case is an insert of the
unmatched rows only.  NULL keys match nothing, in the table or in the batch.

Work: keys come first.  Into a table that is there, by the hash key, a narrow pass
over the batch reads only the key and partition columns (Catalyst prunes the rest of
the extraction); partitions of which nothing is new are never extracted, shuffled or
staged whole, and only partitions that are known in part join their whole rows.
Other keys write the whole batch, so it is extracted once, into a
staging folder, and its keys are read there.  A first load goes straight to its generation,
whose keys are read before it is published: only a batch with duplicate keys, or with partitions that
fill several files, is written again from there.  A batch's duplicate keys
are found on the keys alone, so only rows that share a key are shuffled.
The keys of a small batch are looked up as literals: the scan of the table then
skips files and row groups by statistics and by the Bloom filters that every
write leaves on the key columns (see ``key_candidates``).

Layout: directory partitions by ``date``; within a date the rows are dealt by
ranges of ``fullVisitorId``, as many as the date fills files, and sorted, so the
files of one write hold disjoint visitor ranges and a filter on the visitor
skips files by their statistics (see ``write_clustered``).

Safety: every write is a new generation of the table, which readers see when its
pointer appears and not before (see ``snapshots``).  A write that stops leaves
the table as it was.  Of two writers at a time the second starts again from what
the first has published, so both batches are merged, one after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType

from hitloom import fs, spec
from hitloom.operators import snapshots
from hitloom.operators.snapshots import Conflict, State
from hitloom.session import conf_override, work_dir

PARTITION_COLUMN = "date"
CLUSTER_COLUMN = "fullVisitorId"
MAX_RECORDS_PER_FILE = 1_000_000
TRIES = 20
# Up to as many rows a batch's keys are looked up as literals; beyond, by the join alone.  Results do not depend on it.
LOOKED_UP = 500
# Unshredded: reports flatten the blobs whole, and every scalar is its own column.
UNSHREDDED = {"spark.sql.variant.writeShredding.enabled": "false"}


@dataclass
class UpsertResult:
    path: str
    first_load: bool
    inserted: int
    replaced_partitions: int = 0
    # Partition values whose content changed (None: all).
    touched: list | None = None


def staging_path(spark: SparkSession, name: str = "batch") -> str:
    return f"{work_dir(spark)}/staging/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "batch", created: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a fresh staging folder and read it back.  Staged data is
    read once or twice and dropped, so variants are not shredded.  The folder
    is appended to ``created`` so the caller can remove it once done."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    with conf_override(spark, UNSHREDDED):
        df.write.mode("overwrite").parquet(path)
    if created is not None:
        created.append(path)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ layout

def range_key(cluster_by: str) -> Column:
    """An order-preserving number of a column's value: its first seven bytes as text, NULL lowest."""
    text = F.substring(F.rpad(F.col(cluster_by).cast("string").cast("binary"), 7, F.lit(b"\x00")), 1, 7)
    return F.coalesce(F.conv(F.hex(text), 16, 10).cast("bigint"), F.lit(-1))


def range_cuts(narrow: DataFrame, partition_by: str | None, cluster_by: str, max_records: int) -> DataFrame | None:
    """Where to cut partitions that fill several files: (partition, cuts), one row each; None if all fit one.

    The cuts are approximate quantiles of ``range_key``, an aggregate of the narrow ``narrow`` that
    combines map-side; a partition that fits one file has none and is left out."""
    group = [partition_by] if partition_by else []
    sizes = narrow.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_records)
    files = int(sizes.agg(F.max(F.ceil(F.col("_n") / max_records))).first()[0] or 1)
    if files == 1:
        return None
    shares = [i / files for i in range(1, files)]  # the same for all: a smaller partition gets more, smaller files
    cuts = F.array_distinct(F.percentile_approx("_key", shares, 10_000))
    some = narrow.withColumn("_key", range_key(cluster_by))
    if group:
        some = some.join(sizes.select(*[F.col(g).alias("_p") for g in group]), F.col(group[0]).eqNullSafe(F.col("_p")), "left_semi")
    return some.groupBy(*[F.col(g).alias("_p") for g in group]).agg(cuts.alias("_cuts"))


def write_clustered(df: DataFrame, path: str, partition_by: str | None = PARTITION_COLUMN, cluster_by: str = CLUSTER_COLUMN,
                    max_records: int = MAX_RECORDS_PER_FILE, cuts: DataFrame | None = None, keys: Iterable[str] = ()) -> int:
    """Write to the fresh folder ``path`` with the table layout; returns the number of rows written.

    ``keys`` get Bloom filters, sized by the distinct values of their row group (at most 1 MB).

    Rows are rebalanced by partition and by the range that ``cuts`` puts them in, so a file
    holds one range of one partition; without cuts a partition is one range.  AQE coalesces small
    ones and splits those that are still too large."""
    spark = df.sparkSession
    order = [c for c in (partition_by, cluster_by) if c]
    obs = Observation()
    columns, dealt = df.columns, [order[0]]
    if cuts is not None:
        if partition_by:
            df = df.join(cuts, F.col(partition_by).eqNullSafe(F.col("_p")), "left")
        else:  # one row: a number for each file
            df = df.withColumn("_cuts", F.array(*[F.lit(c) for c in cuts.first()["_cuts"]]).cast("array<bigint>"))
        df = df.withColumn(
            "_range", F.coalesce(F.size(F.filter("_cuts", lambda c: c < range_key(cluster_by))), F.lit(0)))
        dealt = [*([partition_by] if partition_by else []), "_range"]
    out = df.hint("rebalance", *dealt).sortWithinPartitions(*dict.fromkeys([*dealt, *order])).select(*columns)
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = out.write.mode("overwrite").option("maxRecordsPerFile", max_records)
    if partition_by:
        w = w.partitionBy(partition_by).option("partitionOverwriteMode", "static")
    for key in keys:
        if key != partition_by and _looked_up_by_value(df.schema[key].dataType):
            w = w.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    with conf_override(spark, UNSHREDDED):
        w.parquet(path)
    return int(obs.get["rows"])


def _values(df: DataFrame, col: str) -> list:
    """Distinct values of a partition column.  Their number is that of the
    partition folders, which the table's pointer lists anyway."""
    return [r[0] for r in df.select(col).distinct().collect()]


def _sizes(df: DataFrame, col: str | None) -> dict:
    """Rows of each partition (one, None, without partitions)."""
    return {(r[0] if col else None): r["count"] for r in df.groupBy(*([col] if col else [])).count().collect() if r["count"]}


def _texts(df: DataFrame, col: str, values: list) -> set[str | None]:
    """``values`` of the column as they stand in folder names."""
    rows = df.sparkSession.createDataFrame([(v,) for v in values], df.select(F.col(col).alias("v")).schema)
    return {r[0] for r in rows.select(F.col("v").cast("string")).collect()}


def _in(col: str | None, values: list | None):
    if col is None or values is None:
        return F.lit(True)
    known = [v for v in values if v is not None]
    cond = F.col(col).isin(known) if known else F.lit(False)
    if len(known) != len(values):
        cond = cond | F.col(col).isNull()
    return cond


# ------------------------------------------------------------------ lookup

def _looked_up_by_value(kind: DataType) -> bool:
    """Types whose equal values have equal bytes in a file (not so 0.0 and -0.0, or texts of another collation)."""
    return isinstance(kind, (IntegralType, DateType)) or kind == StringType()


def key_candidates(table: DataFrame, batch_keys: DataFrame, keys: list[str], partition_by: str | None,
                   limit: int = LOOKED_UP) -> DataFrame:
    """Rows of ``table`` among which every match of ``batch_keys`` is: with at most ``limit`` rows in the
    batch, those whose every key column holds one of the batch's values, else all.

    At most ``limit`` + 1 narrow rows come to the driver.  The literals reach the Parquet scan within ``looking_up``."""
    by_value = [k for k in keys if k != partition_by and _looked_up_by_value(table.schema[k].dataType)
                and batch_keys.schema[k].dataType == table.schema[k].dataType]
    rows = batch_keys.select(*by_value).limit(limit + 1).collect() if by_value else []
    if not by_value or len(rows) > limit:
        return table
    found = table
    for k in by_value:
        values = list({r[k] for r in rows if r[k] is not None})
        if not any(isinstance(v, str) and "\ufffd" in v for v in values):  # bytes that are no text came as another text
            found = found.where(F.col(k).isin(values) if values else F.lit(False))
    return found


def looking_up(spark: SparkSession, limit: int = LOOKED_UP):
    """While this is open, Parquet scans take up to ``limit`` literals of a column as equalities, which Bloom
    filters answer (Spark's own limit is 10; beyond it only the least and the largest value count)."""
    return conf_override(spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(limit)})


# ------------------------------------------------------------------ upsert

def table_schema(df: DataFrame, partition_by: str | None) -> dict:
    """The table's columns in the order in which its files are read back: the partition column last."""
    last = [c for c in df.columns if c != partition_by] + ([partition_by] if partition_by else [])
    return df.select(*last).schema.jsonValue()


def upsert(new: DataFrame, target: str, keys: tuple[str, ...] = spec.DEFAULT_MERGE_KEYS,
           duplicates: str = "first", partition_by: str | None = PARTITION_COLUMN,
           cluster_by: str = CLUSTER_COLUMN, max_records: int = MAX_RECORDS_PER_FILE) -> UpsertResult:
    """Merge ``new`` into the table at ``target`` on ``keys`` (see module doc).

    ``duplicates``: equal keys inside the batch are collapsed to one row
    (``first``, makes reruns idempotent), kept (``keep``) or rejected
    (``error``).  A missing table is created from the batch; parquet files that
    somebody else has put there are adopted.  Staging copies are removed."""
    if duplicates not in ("first", "keep", "error"):
        raise ValueError(f"unknown duplicates policy {duplicates!r}")
    spark = new.sparkSession
    target = target.rstrip("/")
    for attempt in range(TRIES):
        base = snapshots.adopt(spark, target, partition_by)
        gen = snapshots.new_generation(base)
        created: list[str] = []
        try:
            return _upsert(new, target, base, gen, list(keys), duplicates, partition_by, cluster_by, max_records, created)
        except Conflict:
            fs.delete(spark, snapshots.generation_path(target, gen))
            if attempt == TRIES - 1:
                raise
        finally:
            for path in created:
                fs.delete(spark, path)
    raise AssertionError("unreachable")


def _upsert(new: DataFrame, target: str, base: State | None, gen: str, keys: list[str], duplicates: str,
            partition_by: str | None, cluster_by: str, max_records: int, created: list[str]) -> UpsertResult:
    spark = new.sparkSession
    narrow = list(dict.fromkeys([*keys, cluster_by, *([partition_by] if partition_by else [])]))
    no_null = _no_null(keys)

    def one_of_each(df: DataFrame, key_rows: DataFrame) -> DataFrame:
        """``df`` without the copies inside the batch.  ``key_rows`` are its keys."""
        if duplicates == "keep":
            return df
        again = key_rows.where(no_null).groupBy(*keys).count().where("count > 1").select(*keys)
        again = stage(again, "repeated", created)
        if again.isEmpty():
            return df
        if duplicates == "error":
            raise ValueError(f"duplicate keys in batch, e.g. {again.first().asDict()}")
        if staged is None or df is not staged:  # read twice below
            df = stage(df, "copies", created)
        # Copies are combined map-side before the shuffle, so a key repeated in
        # a third of the batch never reaches one task whole.
        return (df.join(again, keys, "left_anti")
                .unionByName(df.join(again, keys, "left_semi").dropDuplicates(keys)))

    def write(rows: DataFrame, about: DataFrame) -> tuple[int, list[str]]:
        cuts = range_cuts(about, partition_by, cluster_by, max_records)
        n = write_clustered(rows, snapshots.generation_path(target, gen), partition_by, cluster_by, max_records, cuts, keys)
        return n, snapshots.written_parts(spark, target, gen, partition_by)

    note = {"schema": table_schema(new, partition_by)} if base is None else base.note
    if base is not None and {f["name"] for f in note["schema"]["fields"]} != set(new.columns):
        raise ValueError(f"the batch has other columns than the table at {target}")
    # What is written whole anyway is extracted once, and its keys are columns of the staged rows.
    by_hash = base is not None and spec.HASH_COLUMN in keys
    straight = base is None and partition_by not in keys   # a partition's value is read back from a folder's name
    if straight:
        created.append(snapshots.generation_path(target, first := snapshots.new_generation(None)))
        n = write_clustered(new, snapshots.generation_path(target, first), partition_by, cluster_by, max_records, None, keys)
        parts = snapshots.written_parts(spark, target, first, partition_by)
        staged = snapshots.read(spark, target, at=State(0, {p: (first,) for p in parts}, note))
    else:
        staged = None if by_hash else stage(new, "batch", created)
    key_rows = stage(new.select(*narrow), "keys", created) if by_hash else staged.select(*narrow)
    if base is None:
        rows = one_of_each(staged, key_rows)
        if straight and rows is staged and range_cuts(key_rows, partition_by, cluster_by, max_records) is None:
            snapshots.publish(spark, target, None, {p: (first,) for p in parts}, note)
            created.remove(snapshots.generation_path(target, first))
            return UpsertResult(target, True, n, touched=None)
        n, parts = write(rows, key_rows)
        snapshots.publish(spark, target, None, {p: (gen,) for p in parts}, note)
        return UpsertResult(target, True, n, touched=None)

    table = snapshots.read(spark, target, at=base)
    values = _values(key_rows, partition_by) if partition_by else None
    if by_hash:
        # Equal hash means equal document, hence equal partition value:
        # pruning the table to the batch's partitions cannot lose a match.
        existing = key_candidates(table.filter(_in(partition_by, values)), key_rows, keys, partition_by).select(*keys)
        with looking_up(spark):
            known = stage(key_rows.join(existing, keys, "left_semi"), "known", created)
        if duplicates == "error":
            one_of_each(new, key_rows)
        # Partitions of which the table holds nothing or everything need no join of whole rows.
        batch_n, known_n = _sizes(key_rows, partition_by), _sizes(known, partition_by)
        touched = [p for p, n in batch_n.items() if known_n.get(p, 0) < n]
        if not touched:
            return UpsertResult(target, False, 0, touched=[])
        mixed = [p for p in touched if p in known_n]
        if not partition_by:
            touched, mixed = None, mixed and None

        def fresh_of(rows: DataFrame) -> DataFrame:
            """Rows the table does not hold; those with a NULL key always are."""
            rows = rows.where(_in(partition_by, touched))
            if mixed == []:
                return rows
            return rows.join(known.where(_in(partition_by, mixed)).select(*keys).distinct(), keys, "left_anti").select(*rows.columns)

        fresh_keys = fresh_of(key_rows)
        n, parts = write(one_of_each(fresh_of(new), fresh_keys), fresh_keys)
        snapshots.publish(spark, target, base, {**base.parts, **{p: (*base.parts.get(p, ()), gen) for p in parts}}, note)
        return UpsertResult(target, False, n, touched=touched)

    # General keys: a matched row may sit in another partition than its
    # replacement, so the affected partitions are the batch's plus those of
    # matched rows.  They are rebuilt whole in the new generation; all others
    # stay in theirs.
    batch = one_of_each(staged, key_rows)
    if batch is not staged:
        batch = stage(batch, "distinct", created)
    batch_keys = batch.select(*keys)
    affected, stay = None, {}
    if partition_by:
        same = key_candidates(table, key_rows, keys, partition_by)
        with looking_up(spark):
            matched = _values(same.select(*narrow).join(batch_keys, keys, "left_semi"), partition_by)
        affected = list({*values, *matched})
        texts = _texts(table, partition_by, affected)
        stay = {p: g for p, g in base.parts.items() if snapshots.part_value(p) not in texts}
    in_scope = table.filter(_in(partition_by, affected))
    with looking_up(spark):
        n_new = batch.join(key_candidates(in_scope, key_rows, keys, partition_by).select(*keys), keys, "left_anti").count()
    merged = in_scope.join(batch_keys, keys, "left_anti").unionByName(batch)
    _, parts = write(merged, merged.select(*narrow))
    snapshots.publish(spark, target, base, {**stay, **{p: (gen,) for p in parts}}, note)
    return UpsertResult(target, False, n_new, replaced_partitions=len(affected) if affected is not None else -1, touched=affected)


def _no_null(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
