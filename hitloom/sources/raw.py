"""Raw layer: list input files, read JSON documents into one variant column.

Every input file is listed on each run (no prefix, filter or high-water mark);
for an incremental variant see ``hitloom.streaming``.  Gzip files are not
splittable, so each file is one input task; the read is repartitioned by the
caller when files are few and large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom import fs

RAW_COLUMN = "raw_text"


def list_input_files(spark: SparkSession, root: str, suffix: str = "") -> list[str]:
    """All data files below ``root`` (recursive)."""
    return fs.list_files(spark, root, suffix)


def load_raw(spark: SparkSession, paths: str | list[str], mode: str = "FAILFAST",
             multi_line: bool = False, split_arrays: bool = True,
             with_source: bool = False, path_glob: str | None = None,
             spread: int | None = None) -> DataFrame:
    """JSON documents (optionally gzip) to a single variant column ``raw_text``.

    ``mode``: FAILFAST (default) raises on a malformed line, PERMISSIVE gives
    a NULL row, DROPMALFORMED drops it; blank lines are skipped in every mode.
    A line holding an array of documents is split into its documents when
    ``split_arrays`` is set.  ``with_source`` adds the file path.

    Sub-folders are read at any depth, as ``list_input_files`` lists them.
    ``spread``: gzip files cannot be split, so a few large files give a few
    long scan tasks; given a number, the parsed documents are dealt
    round-robin to that many tasks.
    """
    reader = (spark.read.format("json")
              .option("singleVariantColumn", RAW_COLUMN)
              .option("mode", mode)
              .option("multiLine", str(multi_line).lower())
              .option("recursiveFileLookup", "true"))
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.load(paths)
    cols = [F.col(RAW_COLUMN)]
    if with_source:
        cols.append(F.col("_metadata.file_path").alias("source_file"))
    df = df.select(*cols)
    if split_arrays:
        arr = F.try_variant_get(F.col(RAW_COLUMN), "$", "array<variant>")
        df = df.withColumn(RAW_COLUMN, F.explode(F.coalesce(arr, F.array(F.col(RAW_COLUMN)))))
    return df.repartition(spread) if spread else df


def raw_from_text(docs: DataFrame, text_col: str = "doc") -> DataFrame:
    """Documents already held as JSON text (e.g. a table column) to the raw
    variant column, with the same strictness as the file reader."""
    return docs.select(F.parse_json(F.col(text_col)).alias(RAW_COLUMN))


def write_json_files(docs: DataFrame, path: str, text_col: str = "doc",
                     compression: str = "gzip") -> None:
    """Write documents as JSON-lines files, one document per line."""
    (docs.select(F.col(text_col).alias("value"))
     .write.mode("overwrite").option("compression", compression).text(path))
