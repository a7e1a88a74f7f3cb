"""Finding events in the forensic table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.functions.session import fresh_path
from rampart.sinks import forensic


def search_events(
    table: DataFrame, where: str | Column = "true", args: dict | None = None, limit: int = 50
) -> DataFrame:
    """The newest rows that meet a condition; of equal times the greatest event id first.

    ``args`` are values for named markers (``:name``) in the condition; they are
    bound, not pasted.  Sort and limit become one top-k per task and a merge.
    """
    if args:
        spark = table.sparkSession
        found = spark.sql(f"SELECT * FROM {{events}} WHERE {where}", args=args, events=table)
    else:
        found = table.where(where)
    return found.orderBy(F.col("ingestion_timestamp").desc(), F.col("event_id").desc()).limit(limit)


def events_of_vendor(table: DataFrame, vendor: str | None = None, limit: int = 50) -> DataFrame:
    """The newest rows, optionally of one vendor."""
    return search_events(table, F.col("vendor") == vendor if vendor else "true", limit=limit)


def newest_events(
    spark: SparkSession, path: str, where: str | Column = "true", args: dict | None = None, limit: int = 50
) -> DataFrame:
    """The same on a stored table, from its newest day backwards: one day, then two, then
    four, until the limit is full.  Days before are not read.

    What each step finds, at most ``limit`` rows, is stored in the shared folder.
    """
    state = forensic.manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"no forensic table at {path}")
    days = state.days()[::-1]
    found, first, width = [], 0, 1
    missing = limit
    while first < len(days) and missing > 0:
        table = forensic.read_forensic(spark, path, days=days[first : first + width], state=state)
        step = fresh_path(spark, "newest")
        search_events(table, where, args, missing).write.parquet(step)
        missing -= spark.read.parquet(step).count()
        found.append(step)
        first, width = first + width, 2 * width
    if not found:
        return forensic.read_forensic(spark, path, days=[], state=state)
    return search_events(spark.read.parquet(*found), limit=limit)


def matching_text(table: DataFrame, query: str) -> DataFrame:
    """Rows in which a text occurs in vendor, action, protocol or an address.

    The query is lower-cased; addresses are compared as they are.
    """
    needle = F.lit(query.lower().strip())
    if not query.strip():
        return table
    test = F.lit(False)
    for name in ("vendor", "action", "protocol"):
        test = test | F.contains(F.lower(name), needle)
    for name in ("src_ip", "dst_ip"):
        test = test | F.contains(F.col(name), needle)
    return table.where(F.coalesce(test, F.lit(False)))


LOOKUP_KEYS = ["raw_hash", "src_ip", "dst_ip", "vendor", "action", "severity"]


def events_by_key(table: DataFrame, **keys) -> DataFrame:
    """Rows equal to the given lookup keys (pushed down to the Parquet scan)."""
    for name, value in keys.items():
        if name not in LOOKUP_KEYS:
            raise ValueError(f"not a lookup key: {name} (one of {', '.join(LOOKUP_KEYS)})")
        table = table.where(F.col(name) == value)
    return table
