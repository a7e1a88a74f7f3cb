"""Writers of event tables.

A sink is any callable taking a DataFrame of canonical events.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from inspect import signature

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rampart.functions.session import fresh_path, remove
from rampart.operators.export import event_members, lake_rows, native_json
from rampart.operators.features import feature_matrix
from rampart.sinks.forensic import compact_forensic, read_forensic, upsert_forensic


def write_lake(events: DataFrame, path: str, *, batch_size: int | None = None, mode: str = "append") -> None:
    """Append the 33-column layout as snappy Parquet, partitioned by ingestion date.

    ``batch_size`` limits the rows of one file.
    """
    day = F.to_date("lineage.ingestion_timestamp").alias("ingest_date")
    rows = lake_rows(events, day)
    writer = rows.write.mode(mode).partitionBy("ingest_date").option("compression", "snappy")
    if batch_size:
        writer = writer.option("maxRecordsPerFile", batch_size)
    writer.parquet(path)


def write_jsonl(events: DataFrame, path: str, *, mode: str = "append") -> None:
    """Append full nested events as JSON lines, NULL members included.

    Events normalized with ``details=True`` keep the types of their unmapped tokens.
    """
    if "json_literals" in events.columns:
        events.select(native_json(typed=True)).write.mode(mode).text(path)
        return
    events.select(*event_members()).write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_features(events: DataFrame, path: str, *, mode: str = "append") -> None:
    """Append the feature matrix with the event id as Parquet."""
    feature_matrix(events, F.col("lineage.event_id")).write.mode(mode).parquet(path)


def write_outbox(
    events: DataFrame, path: str, layout: Column | None = None, *, dry_run: bool = False, mode: str = "append"
) -> int:
    """Append one JSON text per event for a forwarder to pick up; returns the count.

    ``layout`` is a struct from ``rampart.operators.export`` (default: the native
    event).  A dry run only counts.
    """
    payload = native_json() if layout is None else F.to_json(layout, {"ignoreNullFields": "false"})
    if dry_run:
        return events.count()
    seen = Observation()
    rows = events.select(payload.alias("value")).observe(seen, F.count("*").alias("n"))
    rows.write.mode(mode).text(path)
    return seen.get["n"]


def per_batch(path: str, batch_id: int) -> str:
    """The folder of one micro-batch in a table; a sink that overwrites it may be called
    again for the same batch."""
    return f"{path}/batch_id={batch_id}"


def fan_out(
    events: DataFrame, sinks: Mapping[str, Callable[..., object]], batch_id: int | None = None
) -> dict[str, str | None]:
    """Send the same events to several sinks; one failing does not stop the others.

    The events (random ids included) are stored once for all sinks, which so read only
    the columns they need, and removed in the end.  A sink takes the events and, if it
    has a second parameter, the number of the micro-batch.  Returns the error text per
    sink, None where it worked.
    """
    spark = events.sparkSession
    path = fresh_path(spark, "fan-out")
    events.write.parquet(path)
    events = spark.read.schema(events.schema).parquet(path)
    outcome: dict[str, str | None] = {}
    for name, sink in sinks.items():
        try:
            sink(events, batch_id) if len(signature(sink).parameters) > 1 else sink(events)
            outcome[name] = None
        except Exception as problem:  # noqa: BLE001 - isolation of sinks is the point
            warnings.warn(f"sink {name} failed: {problem}", stacklevel=2)
            outcome[name] = str(problem)
    remove(spark, path)
    return outcome


__all__ = [
    "write_lake", "write_jsonl", "write_features", "write_outbox", "fan_out", "per_batch",
    "upsert_forensic", "read_forensic", "compact_forensic",
]
