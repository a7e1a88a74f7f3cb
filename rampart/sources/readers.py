"""Readers of raw lines and of stored events.

The line readers give a DataFrame with one ``raw_event`` column and work the same
on a static and on a streaming input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions.text import strip
from rampart.schema import event_schema

# Fixed value: everything that ends a line inside a datagram.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def clean_lines(df: DataFrame, column: str = "value", *, comment_before_strip: bool = False) -> DataFrame:
    """Drop blank and comment lines; broken UTF-8 becomes replacement characters.

    ``comment_before_strip`` keeps indented ``#`` lines.
    """
    text = F.make_valid_utf8(F.col(column).cast("string"))
    tested = text if comment_before_strip else strip(text)
    return (
        df.select(strip(text).alias("raw_event"), F.startswith(tested, F.lit("#")).alias("_comment"))
        .where("raw_event <> '' AND NOT _comment")
        .select("raw_event")
    )


def read_lines(spark: SparkSession, path: str | list[str], *, comment_before_strip: bool = False) -> DataFrame:
    """Log lines of files or folders (any scheme Spark reads); a missing path raises."""
    return clean_lines(spark.read.text(path), comment_before_strip=comment_before_strip)


def stream_lines(spark: SparkSession, path: str, *, max_files: int | None = None) -> DataFrame:
    """Log lines of files as they arrive in a folder."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return clean_lines(reader.text(path))


def lines_from(df: DataFrame, column: str) -> DataFrame:
    """Lines that are already in a string column; only blank ones are dropped."""
    return df.select(strip(F.col(column)).alias("raw_event")).where("raw_event <> ''")


def split_datagrams(df: DataFrame, column: str = "value", *, keep: list[str] | None = None) -> DataFrame:
    """Binary syslog payloads (a Kafka value, a captured datagram) to lines, with the
    ``keep`` columns of their payload."""
    text = F.make_valid_utf8(F.col(column).cast("string"))
    parts = df.select(*(keep or []), F.explode(F.split(text, LINE_ENDS)).alias("raw_event"))
    return parts.withColumn("raw_event", strip(F.col("raw_event"))).where("raw_event <> ''")


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """A data lake written by ``write_lake``."""
    return spark.read.parquet(path)


def read_events_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Canonical events written by ``write_jsonl``."""
    return spark.read.schema(event_schema()).json(path)
