"""Left joins of a large table to a lookup table with one row per key."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.functions.session import stored

# A lookup table of at most this many bytes (its rows as JSON text) is sent to every
# executor.
BROADCAST_BYTES = 32 << 20
# Beyond it, each key of the lookup table is repeated this often, so that one hot
# key of the large side is spread over as many tasks.
SALTS = 16
_ROW_BYTES = 64


def prepared(table: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The table, computed once and stored in the shared folder, and whether its checked
    size allows a broadcast."""
    kept = stored(table, "lookup")
    width = F.octet_length(F.to_json(F.struct(*kept.columns))) + F.lit(_ROW_BYTES)
    size = kept.agg(F.sum(width.cast("long"))).first()[0] or 0
    return kept, size <= limit


def _row_hash(df: DataFrame):
    """A hash of a row's plain columns, to tell rows of one key apart."""
    plain = [f.name for f in df.schema if "<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    return F.xxhash64(*plain)


def attach(
    df: DataFrame,
    table: DataFrame,
    key: str,
    table_key: str,
    payload: str,
    *,
    broadcast: bool,
    salts: int = SALTS,
) -> DataFrame:
    """Add ``payload`` of the row of ``table`` whose ``table_key`` equals ``key``.

    ``broadcast`` comes from :func:`prepared`, or from a table of fixed size.  The other
    way is a shuffle join with salted keys: rows of a hot key go to ``salts`` tasks by a
    hash of the row, rows without a key to any task, and every row is kept.
    """
    side = table.select(F.col(table_key).alias("_key"), F.col(payload))
    if broadcast:
        joined = df.join(F.broadcast(side), df[key] == side["_key"], "left")
        return joined.drop("_key")
    row = _row_hash(df)
    salt = F.when(F.col(key).isNull(), row).otherwise(F.pmod(row, F.lit(salts)))
    left = df.withColumn("_salt", salt)
    right = side.withColumn("_side_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    same = (left[key] == right["_key"]) & (left["_salt"] == right["_side_salt"])
    return left.join(right, same, "left").drop("_key", "_salt", "_side_salt")


# A filter has so many bits per key, up to a bound on what is sent to every executor.
FILTER_BITS_PER_KEY = 16
MOST_FILTER_BITS = 1 << 26
# Keys with more than this share of all rows are at most 1 / HOT_SHARE: they are broadcast.
HOT_SHARE = 1 / 1000


def key_filter(keys: DataFrame, column: str) -> tuple[DataFrame, int]:
    """A Bloom filter with one hash, as rows (slot, bits) of 64 bits each, and its size."""
    wanted = FILTER_BITS_PER_KEY * max(1, keys.count())
    size = min(MOST_FILTER_BITS, max(64, 1 << (wanted - 1).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(size))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    slots = keys.select(F.shiftright(place, 6).alias("slot"), one.alias("bit"))
    return stored(slots.groupBy("slot").agg(F.bit_or("bit").alias("bits")), "key-filter"), size


def with_maybe(df: DataFrame, key: str, filter_: tuple[DataFrame, int], name: str) -> DataFrame:
    """Add ``name``: false where the filter proves that the key is not among its keys."""
    slots, size = filter_
    place = F.pmod(F.xxhash64(key), F.lit(size))
    slots = F.broadcast(slots.select(F.col("slot").alias("_slot"), F.col("bits").alias("_bits")))
    joined = df.join(slots, F.shiftright(place, 6) == F.col("_slot"), "left")
    hit = F.getbit("_bits", place.bitwiseAND(F.lit(63)).cast("int")) == 1
    return joined.select(*df.columns, (F.col(key).isNotNull() & F.coalesce(hit, F.lit(False))).alias(name))


def by_value(
    df: DataFrame,
    keys: list[str],
    resolve: Callable[[DataFrame], DataFrame],
    *,
    source: DataFrame,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``_hit_<key>`` for each key column: what a large lookup says of its value.

    ``resolve`` takes the distinct values (value) and returns those that have a hit
    (value, hit), one row each; so the lookup table meets each value once, however hot.
    ``source`` is a stored table with the same key columns as ``df``.

    Hits whose checked size allows it are broadcast: rows are not shuffled at all.
    Otherwise a Bloom filter of their values, broadcast too, tells rows without a hit,
    which stay where they are; values of many rows are broadcast, and only the rest of
    the rows with a hit are shuffled.
    """
    each = source.select(F.explode(F.array(*keys)).alias("value")).where("value <> ''")
    values = stored(each.groupBy("value").agg(F.count("*").alias("rows")), "lookup-values")
    hits, fits = prepared(resolve(values.select("value")), limit)
    if fits:
        for key in keys:
            side = F.broadcast(hits.select(F.col("value").alias("_value"), F.col("hit").alias(f"_hit_{key}")))
            df = df.join(side, df[key] == side["_value"], "left").drop("_value")
        return df
    filter_ = key_filter(hits, "value")
    base = df.columns
    for key in keys:
        df = with_maybe(df, key, filter_, f"_may_{key}")
    some = reduce(lambda a, b: a | b, (F.col(f"_may_{key}") for key in keys))
    none = F.lit(None).cast(hits.schema["hit"].dataType)
    missed = df.where(~some).select(*base, *(none.alias(f"_hit_{key}") for key in keys))
    most = max(256, int(HOT_SHARE * len(keys) * source.count()))
    counted = hits.join(values, "value")
    hot = counted.where(F.col("rows") > most).select("value", F.col("hit").alias("_hot"))
    cold = counted.where(F.col("rows") <= most).select("value", F.col("hit").alias("_cold"))
    rest = df.where(some)
    for key in keys:
        rest = attach(rest, hot, key, "value", "_hot", broadcast=True)
        rest = rest.withColumn("_open", F.when(F.col("_hot").isNull() & F.col(f"_may_{key}"), F.col(key)))
        rest = attach(rest, cold, "_open", "value", "_cold", broadcast=False, salts=1)
        rest = rest.withColumn(f"_hit_{key}", F.coalesce("_hot", "_cold")).drop("_hot", "_cold", "_open")
    return missed.unionByName(rest.select(*missed.columns))


def found_values(values: DataFrame, table: DataFrame, key: str, hit: Column) -> DataFrame:
    """What :func:`by_value` asks of a table with one row per ``key``: values that a Bloom
    filter of its keys lets pass are joined with it."""
    passed = with_maybe(values, "value", key_filter(table, key), "_may").where("_may").select("value")
    return passed.join(table.select(F.col(key).alias("value"), hit.alias("hit")), "value")
