"""Small file operations through Spark's own Hadoop file systems, so that they
work wherever Spark reads and writes (local folders, HDFS, object stores).

Only names, sizes and records of a few bytes pass through here; table data is
always read and written by Spark jobs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class File:
    path: str
    size: int


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is not there is no error."""
    p, fs = _path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path``."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def data_files(spark: SparkSession, path: str) -> list[File]:
    """All files under ``path`` that Spark would read, with their sizes."""
    p, fs = _path(spark, path)
    top, out, todo = p.toUri().getPath(), [], fs.listFiles(p, True)
    while todo.hasNext():
        s = todo.next()
        below = s.getPath().toUri().getPath()[len(top):]
        if not any(x.startswith(("_", ".")) and "=" not in x for x in below.split("/")):
            out.append(File(s.getPath().toString(), s.getLen()))
    return sorted(out, key=lambda f: f.path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file whole: under another name first, then renamed
    over ``path``, so a reader sees the old text or the new one, never a part."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    p, fs = _path(spark, path)
    staged = hadoop.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(staged, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(hadoop, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(staged), fs.makeQualified(p), over)
