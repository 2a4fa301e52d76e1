"""Small file-system helpers over Hadoop's FileSystem API.

They work for any URI scheme the cluster mounts (hdfs://, s3a://, file:/),
because they go through the same FileSystem object Spark itself uses.
Only metadata calls live here — no data passes through the driver.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


def has_data(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds a table written by Spark (a committed folder)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return False
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith(".") or name == "_temporary":
            continue                      # hidden files, in-flight job output
        if st.isDirectory() and "=" in name:
            return True                   # partition folder, e.g. _bucket=3
        if not name.startswith("_") or name == "_SUCCESS":
            return True
    return False


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-folders (partition folders) of ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data file paths directly under ``path``, sorted by name."""
    fs, p = _fs(spark, path)
    return sorted(str(st.getPath()) for st in fs.listStatus(p)
                  if st.isFile() and not st.getPath().getName().startswith((".", "_")))


def stamp_in_order(spark: SparkSession, paths: list[str], step_ms: int = 1000) -> None:
    """Give files strictly increasing modification times in list order."""
    if not paths:
        return
    fs, _ = _fs(spark, paths[0])
    jvm = spark.sparkContext._jvm
    base = int(fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(paths[0])).getModificationTime())
    for i, f in enumerate(paths):
        fs.setTimes(jvm.org.apache.hadoop.fs.Path(f), base + i * step_ms, -1)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored under ``path`` (a metadata call)."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` unless it exists; readers see it whole or not at all.

    The text is written beside it and renamed without overwriting, which is
    atomic on HDFS.  Returns False if another writer came first.
    """
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    tmp = f"{p.getParent().toString()}/.{p.getName()}.{uuid.uuid4().hex}"
    write_text(spark, tmp, text)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(tmp), p, none)
        return True
    except Py4JJavaError as e:
        if not fs.exists(p):
            raise
        del e
        return False
    finally:
        delete(spark, tmp)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files directly under ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p)
                  if st.isFile() and not st.getPath().getName().startswith("."))


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())
