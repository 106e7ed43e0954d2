"""Small files that jobs agree by, on whatever file system a path is on."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _hadoop(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(target))


def delete(spark: SparkSession, path: str) -> None:
    system, target = _hadoop(spark, path)
    system.delete(target, True)


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds."""
    system, target = _hadoop(spark, path)
    return system.getFileStatus(target).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or none if there is no such file."""
    system, target = _hadoop(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole text by one rename; false if it is there already.

    Readers see all of it or nothing, and of two writers one succeeds, on file systems with an
    atomic rename.
    """
    folder, name = path.rsplit("/", 1)
    system, draft = _hadoop(spark, f"{folder}/_draft-{name.lstrip('_')}-{uuid.uuid4().hex}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    choices = spark.sparkContext._gateway.new_array(rename, 1)
    choices[0] = rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(draft, target, choices)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        system.delete(draft, False)
        return False
    return True
