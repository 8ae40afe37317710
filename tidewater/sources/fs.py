"""Small file-system helpers over the Hadoop FileSystem API, so paths on
shared cluster storage work the same as local ones."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = spark.sparkContext._jvm.java.io.BufferedReader(
            spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def total_size(spark: SparkSession, path: str) -> int:
    """Bytes under a path (used to bound what may be broadcast)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file whole, only if its name is free: the text is written under
    a hidden name and renamed without overwriting. False when the name is taken."""
    jvm = spark.sparkContext._jvm
    fs, target = _fs(spark, path)
    hidden = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        if target.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = getattr(jvm.org.apache.hadoop.fs.Options.Rename, "NONE")
    try:
        context.rename(fs.makeQualified(hidden), fs.makeQualified(target), none)
    except Exception as exc:  # noqa: BLE001 - py4j wraps FileAlreadyExistsException
        fs.delete(hidden, False)
        if "AlreadyExists" in str(exc) or "already exists" in str(exc):
            return False
        raise
    return True


def delete_tree(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def replace_tree(spark: SparkSession, source: str, target: str) -> None:
    """Puts the folder ``source`` in the place of ``target``."""
    fs, s = _fs(spark, source)
    t = _fs(spark, target)[1]
    fs.delete(t, True)
    if not fs.rename(s, t):
        raise OSError(f"cannot rename {source} to {target}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder, making the folders above its new place."""
    fs, s = _fs(spark, source)
    t = _fs(spark, target)[1]
    fs.mkdirs(t.getParent())
    if not fs.rename(s, t):
        raise OSError(f"cannot rename {source} to {target}")
