"""The forensic table: appended segments, the newest row of each id at read, compaction.

A table is a folder with ``data/segment=.../ingest_day=...`` (Parquet) and ``_manifest``,
whose latest file lists the segments that count.  A batch writes its own rows as a segment
and nothing else, then a new manifest; what is not in the manifest does not exist, so a
lost job leaves no trace and can be repeated.

A later batch replaces rows of equal ids (of one batch, the newest row counts).  Nothing is
rewritten for that: the ids of segments that replace rows are read, one narrow column, and
older rows with such an id are dropped where the table is read.  Segments of new ids and
compacted ones need no such look.

``compact_forensic`` writes the rows that count of the days in question anew, on a
space-filling curve over the looked-up keys, as one segment without replaced rows.  Days
that it need not touch stay as they are.  It goes through the days in rounds of bounded
size, so what is shuffled at a time does not grow with the table (a day is never cut).
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rampart.functions.files import names, publish, read_text
from rampart.functions.session import remove, shuffles_removed, small_splits
from rampart.operators.export import forensic_rows
from rampart.operators.layout import cuts, interleaved
from rampart.operators.lookup import BROADCAST_BYTES
from rampart.schema import FORENSIC_COLUMNS

KEYS = ["raw_hash", "src_ip", "dst_ip", "vendor", "action", "severity"]
BITS = 5
# A task sorts the rows of its file, some KB each, in its memory.
ROWS_PER_FILE = 200_000
# A task that sorts whole rows reads so much of stored ones, which are packed ten times and more.
_SPLIT_BYTES = 16 << 20
# Bytes that an id and its segment may take when sent to every executor.
_ID_BYTES = 128
# A round of compaction fills the cores once, or so many.
_ROUND_FILES = 8
# 2 KB to 1 MB: with fewer sizes to choose from, a file of some rows has three filters of 64 KB.
_BLOOM_SIZES = 10
_RETRIES = 20


@dataclass(frozen=True)
class Segment:
    """Rows of one write.  ``fresh``: none of its ids is in an older segment.  ``days`` are
    those that still count, with their rows; ``whole`` if these are all that were written."""

    name: str
    fresh: bool
    clustered: bool
    days: dict[str, int]
    whole: bool = True
    label: str | None = None


@dataclass(frozen=True)
class Manifest:
    """Segments from the oldest to the newest."""

    version: int
    schema: str
    segments: tuple[Segment, ...]

    def days(self) -> list[str]:
        return sorted({day for s in self.segments for day in s.days})


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The latest state of a table, None if there is no table."""
    found = [n for n in names(spark, f"{path}/_manifest") if n.endswith(".json") and not n.startswith(".")]
    if not found:
        return None
    state = json.loads(read_text(spark, f"{path}/_manifest/{found[-1]}"))
    return Manifest(state["version"], state["schema"], tuple(Segment(**s) for s in state["segments"]))


def _commit(spark: SparkSession, path: str, schema: str, change: Callable[[Manifest], list[Segment] | None]) -> bool:
    """Publish what ``change`` makes of the latest segments; again if another writer was
    faster.  False if there is nothing to change."""
    for _ in range(_RETRIES):
        now = manifest(spark, path) or Manifest(0, schema, ())
        segments = change(now)
        if segments is None:
            return False
        state = {"version": now.version + 1, "schema": now.schema, "segments": [asdict(s) for s in segments]}
        if publish(spark, f"{path}/_manifest", f"{now.version + 1:020d}.json", json.dumps(state)):
            return True
    raise RuntimeError(f"{path}: too many writers at once")


def ingest_day() -> Column:
    """The day of ingestion in UTC, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros("ingestion_timestamp") / F.lit(86_400_000_000)).cast("int"))


def _writer(rows: DataFrame, row_group_bytes: int | None) -> DataFrameWriter:
    """Bloom filters, as large as their columns need, on what is looked up singly."""
    writer = rows.write.partitionBy("ingest_day").option("compression", "zstd").option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in ("raw_hash", "src_ip", "dst_ip"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.candidates.number#{name}", _BLOOM_SIZES)
    return writer.option("parquet.block.size", row_group_bytes) if row_group_bytes else writer


def _written(spark: SparkSession, path: str, name: str, schema: str) -> dict[str, int]:
    """Rows per day of a segment, from its footers."""
    rows = _stored(spark, path, [name], schema).groupBy("ingest_day").count().collect()
    return {str(r.ingest_day): r["count"] for r in rows}


def _stored(spark: SparkSession, path: str, segments: list[str], schema: str) -> DataFrame:
    kinds = T.StructType.fromJson(json.loads(schema)).add("segment", "string").add("ingest_day", "date")
    folders = [f"{path}/data/segment={name}" for name in segments]
    return spark.read.schema(kinds).option("basePath", f"{path}/data").parquet(*folders)


def newest_per_id(rows: DataFrame) -> DataFrame:
    """One row per event id: the newest.  A plain aggregate, so many copies of one
    id are already reduced before the shuffle."""
    plain = [c for c in rows.columns if c not in ("event_id", "ingestion_timestamp")]
    newest = F.max(F.struct("ingestion_timestamp", *plain)).alias("_row")
    return rows.groupBy("event_id").agg(newest).select("event_id", "_row.*").select(*rows.columns)


def upsert_forensic(
    events: DataFrame, path: str, *, fresh_ids: bool = False, label: str | None = None, row_group_bytes: int | None = None
) -> bool:
    """Insert or replace forensic rows by event id; the cost is that of the batch.

    ``fresh_ids`` says that the ids of the batch are distinct and not in the table yet.
    A batch with a ``label`` that the table has already is not written again (False).
    """
    spark = events.sparkSession
    state = manifest(spark, path)
    if label is not None and state and any(s.label == label for s in state.segments):
        return False
    rows = forensic_rows(events)
    schema = rows.schema.json()
    first = uuid.uuid4().hex
    ordered = rows.withColumn("ingest_day", ingest_day()).sortWithinPartitions("ingest_day", "vendor", "src_ip")
    second, second_days = uuid.uuid4().hex, {}
    with shuffles_removed(spark):
        with small_splits(spark, _SPLIT_BYTES):
            _writer(ordered, row_group_bytes).parquet(f"{path}/data/segment={first}")
        days = _written(spark, path, first, schema)
        if not fresh_ids and days:
            own = _stored(spark, path, [first], schema)
            repeated = own.groupBy("event_id").count().where("count > 1").select("event_id")
            if not repeated.isEmpty():
                # A second segment with the row that counts of each repeated id.
                again = own.join(repeated, "event_id", "left_semi").drop("segment", "ingest_day").select(*FORENSIC_COLUMNS)
                _writer(newest_per_id(again).withColumn("ingest_day", ingest_day()), row_group_bytes).parquet(f"{path}/data/segment={second}")
                second_days = _written(spark, path, second, schema)

    def change(now: Manifest) -> list[Segment] | None:
        if label is not None and any(s.label == label for s in now.segments):
            return None
        new = [Segment(first, fresh_ids or not now.segments, False, days, label=label)]
        if second_days:
            new.append(Segment(second, False, False, second_days, label=label))
        return [*now.segments, *new]

    return _commit(spark, path, schema, change)


def read_forensic(spark: SparkSession, path: str, *, days: list[str] | None = None, state: Manifest | None = None) -> DataFrame:
    """The rows that count, optionally of some days (as ISO text) only."""
    return _counting(spark, path, days, state).select(*FORENSIC_COLUMNS)


def _counting(spark: SparkSession, path: str, days: list[str] | None, state: Manifest | None) -> DataFrame:
    state = state or manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no forensic table at {path}")
    rows = _live(spark, path, state, days)
    newer = _newer(spark, path, state) if _segments(state, days) else None
    if newer is None:
        return rows
    return rows.join(newer, _replaced(rows, newer, state), "left_anti")


def _segments(state: Manifest, days: list[str] | None) -> list[Segment]:
    wanted = None if days is None else set(days)
    return [s for s in state.segments if s.days and (wanted is None or wanted & set(s.days))]


def _live(spark: SparkSession, path: str, state: Manifest, days: list[str] | None) -> DataFrame:
    """Rows of the listed segments and their days, also those that newer ones replace."""
    live = _segments(state, days)
    if not live:
        kinds = T.StructType.fromJson(json.loads(state.schema)).add("segment", "string").add("ingest_day", "date")
        return spark.createDataFrame([], kinds)
    rows = _stored(spark, path, [s.name for s in live], state.schema)
    day = F.col("ingest_day").cast("string")
    if days is not None:
        rows = rows.where(F.col("ingest_day").isin([_date(d) for d in sorted(set(days))]))
    for s in live:
        if not s.whole:
            rows = rows.where((F.col("segment") != s.name) | day.isin(sorted(s.days)))
    return rows


def _newer(spark: SparkSession, path: str, state: Manifest) -> DataFrame | None:
    newer = winners(spark, path, state)
    if newer is not None and sum(sum(s.days.values()) for s in state.segments if not s.fresh) * _ID_BYTES <= BROADCAST_BYTES:
        newer = F.broadcast(newer)
    return newer


def _replaced(rows: DataFrame, newer: DataFrame, state: Manifest) -> Column:
    ranks = {s.name: i for i, s in enumerate(state.segments)}
    return (rows["event_id"] == newer["_id"]) & (_rank(ranks, rows["segment"]) < newer["_newest"])


def _date(day: str):
    import datetime

    return datetime.date.fromisoformat(day)


def _rank(ranks: dict[str, int], segment: Column) -> Column:
    pairs = [F.lit(x) for pair in ranks.items() for x in pair]
    return F.element_at(F.create_map(*pairs), segment)


def winners(spark: SparkSession, path: str, state: Manifest) -> DataFrame | None:
    """Ids of the segments that replace rows, and the place of the newest segment that has
    each; None if no segment replaces any.  Only the id column is read."""
    replacing = {s.name: i for i, s in enumerate(state.segments) if not s.fresh and s.days}
    if not replacing:
        return None
    ids = _stored(spark, path, list(replacing), state.schema)
    return ids.groupBy(F.col("event_id").alias("_id")).agg(F.max(_rank(replacing, F.col("segment"))).alias("_newest"))


def compact_forensic(
    spark: SparkSession, path: str, *, rows_per_file: int = ROWS_PER_FILE, row_group_bytes: int | None = None
) -> list[str]:
    """Rewrite the days that have new or replaced rows, clustered by the looked-up keys,
    and return them.  A writer that commits meanwhile makes it start again."""
    for _ in range(_RETRIES):
        state = manifest(spark, path)
        if state is None:
            raise FileNotFoundError(f"no forensic table at {path}")
        open_ = [s for s in state.segments if not s.clustered]
        if not open_:
            return []
        name = uuid.uuid4().hex
        with shuffles_removed(spark), _replaced_ids(spark, path, state) as gone:
            dropped = {str(r.ingest_day): r["count"] for r in gone.groupBy("ingest_day").count().collect()} if gone is not None else {}
            days = {day for s in open_ for day in s.days} | set(dropped)
            counts = dict.fromkeys(sorted(days), 0)
            for s in state.segments:
                counts |= {day: counts[day] + n for day, n in s.days.items() if day in days}
            stored = _live(spark, path, state, sorted(days))
            place = interleaved(cuts(stored, KEYS, BITS), BITS)
            for some in _rounds(spark, counts, dropped, rows_per_file):
                own_days = F.col("ingest_day").isin([_date(day) for day in some])
                rows = stored.where(own_days)
                if ids := sum(dropped.get(day, 0) for day in some):
                    own = gone.where(own_days).drop("ingest_day")
                    rows = rows.join(F.broadcast(own) if ids * _ID_BYTES <= BROADCAST_BYTES else own, ["event_id", "segment"], "left_anti")
                # A file has rows of one day only, so some days take as many tasks.
                files = max(1, math.ceil(sum(counts[day] for day in some) / rows_per_file), min(len(some), spark.sparkContext.defaultParallelism))
                ordered = rows.drop("segment").withColumn("_place", place).repartitionByRange(files, "ingest_day", "_place")
                ordered = ordered.sortWithinPartitions("ingest_day", "_place").drop("_place")
                with small_splits(spark, _SPLIT_BYTES):
                    _writer(ordered, row_group_bytes).mode("append").parquet(f"{path}/data/segment={name}")
            new = Segment(name, True, True, _written(spark, path, name, state.schema) if days else {})
        kept = []
        for s in state.segments:
            left = {day: n for day, n in s.days.items() if day not in days}
            if s.clustered and left:
                kept.append(replace(s, days=left, whole=s.whole and left == s.days))
            elif s.label is not None:
                # What remains of a written batch is its label, so that a replay is known.
                kept.append(replace(s, days={}, clustered=True, fresh=True))

        def change(now: Manifest, kept=kept, new=new, state=state) -> list[Segment] | None:
            return [*kept, new] if now.version == state.version else None

        if _commit(spark, path, state.schema, change):
            return sorted(days)
        remove(spark, f"{path}/data/segment={name}")
    raise RuntimeError(f"{path}: too many writers at once")


@contextmanager
def _replaced_ids(spark: SparkSession, path: str, state: Manifest) -> Iterator[DataFrame | None]:
    """Ids of the rows that a newer segment replaces, with their segment and day, as a table
    by days that is there until the block ends; None if no segment replaces any.  It is a
    folder that the manifest does not list, so of a lost job vacuum removes it."""
    newer = _newer(spark, path, state)
    if newer is None:
        yield None
        return
    rows = _live(spark, path, state, None).select("event_id", "segment", "ingest_day")
    gone = rows.join(newer, _replaced(rows, newer, state), "left_semi")
    folder = f"{path}/data/segment={uuid.uuid4().hex}"
    try:
        kinds = T.StructType([gone.schema["event_id"], T.StructField("name", T.StringType()), gone.schema["ingest_day"]])
        by_day = gone.withColumnRenamed("segment", "name").repartitionByRange("ingest_day", "event_id")
        by_day.sortWithinPartitions("ingest_day").write.option("compression", "zstd").parquet(folder)
        yield spark.read.schema(kinds).parquet(folder).withColumnRenamed("name", "segment")
    finally:
        remove(spark, folder)


def _rounds(spark: SparkSession, rows: dict[str, int], dropped: dict[str, int], rows_per_file: int) -> list[list[str]]:
    """Neighbouring days, as many as fill the cores once with tasks and whose replaced ids
    can be sent to every executor; one day at least."""
    most = rows_per_file * max(_ROUND_FILES, spark.sparkContext.defaultParallelism)
    rounds, n, ids = [], 0, 0
    for day in sorted(rows):
        n, ids = n + rows[day], ids + dropped.get(day, 0)
        if not rounds or n > most or ids * _ID_BYTES > BROADCAST_BYTES:
            rounds.append([])
            n, ids = rows[day], dropped.get(day, 0)
        rounds[-1].append(day)
    return rounds


def vacuum_forensic(spark: SparkSession, path: str) -> int:
    """Delete segments that the manifest does not list, and count them.  For times when no
    job writes the table, or reads an older state of it."""
    state = manifest(spark, path)
    listed = {f"segment={s.name}" for s in state.segments if s.days} if state else set()
    gone = [n for n in names(spark, f"{path}/data") if n.startswith("segment=") and n not in listed]
    for name in gone:
        remove(spark, f"{path}/data/{name}")
    return len(gone)
