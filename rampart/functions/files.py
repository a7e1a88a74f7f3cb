"""Small files in any file system that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, system = _path(spark, path)
    return system.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    target, system = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(target)) if system.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    target, system = _path(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Create a file with its whole content at once; False if there is one already.

    The content goes to a hidden file first, which is renamed without overwriting: readers
    see all of it or nothing, and of two writers one succeeds.
    """
    target, system = _path(spark, f"{folder}/{name}")
    draft, _ = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    system.mkdirs(target.getParent())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target):
        system.delete(draft, False)
        return False
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, target, options)
    except Exception as problem:
        system.delete(draft, False)
        if "FileAlreadyExists" in str(problem):
            return False
        raise
    return True
