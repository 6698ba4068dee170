"""Small files and folders through the file system Spark uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it does not exist."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder; False if the target is there already."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = context.getFileContext(_fs(spark, source)[1].getUri(), spark._jsc.hadoopConfiguration())
    if exists(spark, target):
        return False
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(a, b, options)
    except Exception as error:  # another job was faster
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file that appears whole or not at all; False if there is one of that name."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex[:8]}"
    write_text(spark, draft, text)
    if move(spark, draft, path):
        return True
    delete(spark, draft)
    return False
