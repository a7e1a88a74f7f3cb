"""What several operators share: staged tables, batches, partition offsets."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions.session import fresh_path

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
# Texts of one batch are worked on in slices of about this many characters.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: computed once, and read
    again by whatever needs them, also after executors were lost."""
    return staged_twice(df, name)[0]


def staged_twice(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The same, as two frames that can be joined or grouped with each other."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    reader = df.sparkSession.read.schema(df.schema)
    return reader.parquet(path), reader.parquet(path)


def few_rows(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A frame of rows that the driver has.  They go there as an Arrow table: from a list,
    executors would read them by Python workers of another kind, with a daemon that stays."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """First row and texts (NULL: empty) of runs of rows with about ``limit`` bytes.  Only
    the texts of one run are in memory as Python strings."""
    texts = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(ends):
        # Up to the row that reaches the limit, itself included.
        last = min(len(ends), int(np.searchsorted(ends, done + limit)) + 1)
        yield first, [text or "" for text in texts.slice(first, last - first).to_pylist()]
        first, done = last, int(ends[last - 1])


Batches = Iterator[pa.RecordBatch]


# What clears the caches that a worker process keeps from task to task.
_CACHES: list[Callable[[], None]] = []


def kept_between_tasks(cached: Callable) -> Callable:
    """A ``lru_cache`` of a worker process, which tasks that have no use for it clear."""
    _CACHES.append(cached.cache_clear)
    return cached


def _forget() -> None:
    for clear in _CACHES:
        clear()
    give_back()


def give_back() -> None:
    """Memory that this process has freed goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    # Of the C library, where there is such a call.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(function: Callable[[Batches], Batches], keeps: bool = False) -> Callable[[Batches], Batches]:
    """The same for ``mapInArrow``, giving memory back to the machine after each task: a
    worker process lives on, and would keep the greatest peak of all its tasks.  What tasks
    of other operators have left in ``kept_between_tasks`` goes first, unless this one
    ``keeps`` it for its own use."""

    def run(batches: Batches) -> Batches:
        if not keeps:
            _forget()
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def keep_heap(mb: int = 256) -> None:
    """Let this worker keep up to ``mb`` that it has freed, and take arrays of up to 32 MB
    from there: otherwise each batch has its memory mapped and zeroed anew.  ``lean`` still
    gives it back after a task.  Nothing where the C library has no such call."""
    mallopt = getattr(ctypes.CDLL(None), "mallopt", None)
    if mallopt is not None:
        # Fixed values of malloc.h: M_TRIM_THRESHOLD -1, M_MMAP_THRESHOLD -3.
        mallopt(-1, mb << 20)
        mallopt(-3, 32 << 20)


def most_arrow_rows(spark: SparkSession, rows: int) -> None:
    """From now on jobs of this session hand at most so many rows at once to Python: for
    frames of wide rows that someone else runs.  A lower bound of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(min(rows, before) if before > 0 else rows))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs started inside hand at most so many rows at once to Python: for wide rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    most_arrow_rows(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def with_offsets(rows: DataFrame, part: str, total: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``total`` over all rows of smaller ``part``.

    ``part`` numbers the tasks that wrote the rows.  One row per task, 16 bytes each,
    goes to the driver and back.
    """
    spark = rows.sparkSession
    sums = sorted((r[0], r[1] or 0) for r in rows.groupBy(part).agg(F.sum(total)).collect())
    before, offsets = 0, []
    for key, count in sums:
        offsets.append((key, before))
        before += count
    offset_rows = few_rows(spark, offsets, pa.schema([(part, pa.int32()), (name, pa.int64())]))
    return rows.join(F.broadcast(offset_rows), part)
