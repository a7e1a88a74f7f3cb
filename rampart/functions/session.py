"""Scratch space that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only in local mode (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="run-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a Parquet table in the shared folder, computed once."""
    return _stored_at(df, fresh_path(df.sparkSession, name))


def _stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored_meanwhile(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same, until the block ends."""
    path = fresh_path(df.sparkSession, name)
    try:
        yield _stored_at(df, path)
    finally:
        remove(df.sparkSession, path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


@contextmanager
def small_splits(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs started inside read at most so many bytes of files per task: for rows that take
    far more memory than they take on disk."""
    name = "spark.sql.files.maxPartitionBytes"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
    with _setting(spark, name, str(min(size, int(number) << 10 * " kmgtp".index(unit or " ")))):
        yield


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What queries built inside have shuffled is deleted as each ends, not when the driver's
    memory happens to be collected."""
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
