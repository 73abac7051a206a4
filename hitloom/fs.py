"""Small file-system helpers over the Hadoop FileSystem of the session.

They work for any scheme the cluster is configured for (file, hdfs, s3a...),
unlike ``os.path``.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small marker file: a sibling is written whole, then renamed over
    the old one in one step (atomic where the file system's rename is)."""
    p, fs = _path(spark, path)
    tmp, _ = _path(spark, path + ".tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    sc = spark.sparkContext
    rename = sc._jvm.org.apache.hadoop.fs.Options.Rename
    overwrite = sc._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), overwrite)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, in one step, unless it exists; tells whether it did.  Written under a
    hidden name beside it and renamed without overwriting (atomic where the file system's rename is)."""
    folder, _, name = path.rpartition("/")
    p, fs = _path(spark, path)
    tmp, _ = _path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    sc = spark.sparkContext
    rename = sc._jvm.org.apache.hadoop.fs.Options.Rename
    plain = sc._gateway.new_array(rename, 1)
    plain[0] = rename.NONE
    context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(p), plain)
    except Py4JJavaError:
        fs.delete(tmp, False)
        if fs.exists(p):
            return False
        raise
    return True


def move(spark: SparkSession, old: str, new: str) -> None:
    """Rename a file or folder; missing parents of the new name are made."""
    p, fs = _path(spark, old)
    q, _ = _path(spark, new)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder when the session's JVM ends."""
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder (none if it is missing)."""
    p, fs = _path(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Recursive listing of data files below ``path`` (hidden files skipped)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    it = fs.listFiles(p, True)
    out = []
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if name.startswith((".", "_")) or not name.endswith(suffix):
            continue
        out.append(st.getPath().toString())
    return sorted(out)


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p) and fs.delete(p, recursive))


def has_children(spark: SparkSession, path: str) -> bool:
    """True if ``path`` is a folder with at least one non-hidden entry
    (non-recursive: one listing call, whatever the table size)."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith((".", "_")) for st in fs.listStatus(p))
