"""Folders and small files on whatever file system a path names, through Spark's own Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def resolve(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder with all it holds, if it is there."""
    p, fs = resolve(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    p, fs = resolve(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def publish(spark: SparkSession, pending: str, folder: str, name: str) -> None:
    """Puts a written folder in the place of ``folder/name``."""
    source, fs = resolve(spark, pending)
    parent, _ = resolve(spark, folder)
    target, _ = resolve(spark, f"{folder}/{name}")
    fs.mkdirs(parent)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"could not move {pending} to {folder}/{name}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = resolve(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None if it is not there."""
    p, fs = resolve(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
