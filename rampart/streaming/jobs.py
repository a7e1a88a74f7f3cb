"""Structured Streaming jobs around ``normalize``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rampart.operators.normalize import normalize
from rampart.sinks.writers import fan_out
from rampart.specs import shipped_specs


def stream_events(lines: DataFrame, path: str, checkpoint: str, *, once: bool = False, **options) -> StreamingQuery:
    """Normalize a stream of lines and append the events to a Parquet folder."""
    events = normalize(lines, **options)
    writer = events.writeStream.format("parquet").option("path", path)
    return _start(writer.option("checkpointLocation", checkpoint).outputMode("append"), once)


def running_counts(events: DataFrame) -> DataFrame:
    """Valid events per vendor, action and severity over a whole stream.

    Each event counts in three groups; counts are combined per task first.
    """
    groups = F.inline(
        F.array(
            *[
                F.struct(F.lit(dimension).alias("dimension"), F.col(column).alias("name"))
                for dimension, column in (
                    ("vendor", "product.vendor_name"),
                    ("action", "disposition"),
                    ("severity", "severity"),
                )
            ]
        )
    )
    valid = events.where("lineage.is_valid")
    return valid.select(groups).groupBy("dimension", "name").agg(F.count("*").alias("events"))


def stream_to_sinks(
    lines: DataFrame,
    sinks: Mapping[str, Callable[..., object]],
    checkpoint: str,
    *,
    specs_dir: str | None = None,
    once: bool = False,
    on_batch: Callable[[int, dict[str, str | None]], object] | None = None,
    **options,
) -> StreamingQuery:
    """Normalize each micro-batch and send it to several sinks.

    A sink with a second parameter gets the number of the batch, so that it can replace
    what an interrupted attempt at the same batch has left (``per_batch``).  ``on_batch``
    is told the outcome of each batch per sink.

    With ``specs_dir`` the specs of that folder are read again for every batch, on
    top of those known before, so a new parser takes effect without a restart.
    """
    specs = options.pop("specs", None) or shipped_specs()

    def process(batch: DataFrame, batch_id: int) -> None:
        if specs_dir:
            specs.load(specs_dir)
        outcome = fan_out(normalize(batch, specs=specs, **options), sinks, batch_id)
        if on_batch:
            on_batch(batch_id, outcome)

    writer = lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return _start(writer, once)


def _start(writer, once: bool) -> StreamingQuery:
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()
