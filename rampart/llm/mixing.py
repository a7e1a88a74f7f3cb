"""Mixing sources to target weights by weighted sampling without replacement.

Each document draws an exponential key scaled by its quality weight (Efraimidis and
Spirakis), ``-ln(u) / weight`` with u from a hash of its id and text, so reruns agree.  A
source whose target is more than its size is taken whole as often as it fits (complete
epochs); of the rest, its documents are taken in the order of their keys while the prefix
sum of sizes is within the budget, and the document where the budget ends is taken in part.

Prefix sums are two-level: a source's key range is cut into bins of about ``BIN_ROWS``
documents, bins are summed first, and rows are ordered only within a bin.  So a source
with a third of all rows is no heavier for a task than any other.

Rows: every input row is a document of its own, also with a NULL or repeated id; equal rows
may swap places.  A NULL or empty text has size 0 and takes nothing.  A NULL source is a
source, ordered last.  NULL, zero or negative weights count as 1.  Columns of the
input are kept under their names unless they are one of the result's.  An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm.common import WORD, staged

BIN_ROWS = 1_024
# Not a letter and not white space.
NO_PROSE = r"[^\p{L}\x20\x09-\x0D]"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prose_share(text: Column) -> Column:
    """A quality weight from the text alone: the share of letters and white space, 0.05 at
    least; 1 for an empty text."""
    size = F.length(text)
    share = F.lit(1.0) - F.regexp_count(text, F.lit(NO_PROSE)) / size
    return F.when(size > 0, F.greatest(share, F.lit(0.05))).otherwise(F.lit(1.0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Per source its ``target``, from rows (source, source_size).

    Targets share ``share`` of all sizes by weight; what exceeds ``most`` times a source's
    size is shared again by weight among the others, until none exceeds it.  That is the
    one level L with sum(min(most * size, L * weight)) = share * total: sources are filled
    in the order of size / weight.  One row per source is all that is sorted here.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    places = F.array(*[F.lit(float(w)) for w in weights])
    given = sizes.withColumn("_w", F.element_at(places, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1))
    full = F.col("source_size") * F.lit(float(most))
    by_ratio = Window.orderBy(full / F.col("_w"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    steps = given.select(
        "*",
        F.row_number().over(by_ratio).alias("_place"),
        full.alias("_full"),
        F.coalesce(F.sum(full).over(before), F.lit(0.0)).alias("_filled"),
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))).alias("_open"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("_total"),
    )
    # The level if this source and all after it were not full; the first of them fixes it.
    level = (F.col("_total") - F.col("_filled")) / F.col("_open")
    fits = level * F.col("_w") <= F.col("_full")
    first = F.min(F.when(fits, F.struct(F.col("_place"), level.alias("level")))).over(everything)["level"]
    found = steps.select("*", first.alias("_level"))
    at_level = F.least(F.col("_full"), F.col("_level") * F.col("_w"))
    target = F.when(F.col("_level").isNull(), F.col("_full")).otherwise(at_level)
    return found.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    *,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    quality: Callable[[Column], Column] = prose_share,
    text: str = "text",
    source: str = "source",
    identity: tuple[str, ...] = ("doc_id",),
    seed: int = 7,
) -> DataFrame:
    """Add size, source_size, target and taken (words taken, repeats counted).

    ``weights`` repeat over the sources in code point order.  ``identity`` columns and the
    text feed the hash behind the key.
    """
    names = ("size", "source_size", "target", "taken")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    weight = quality(F.col(text))
    weight = F.when(weight > 0, weight).otherwise(F.lit(1.0))
    ids = [F.coalesce(F.col(c).cast("string"), F.lit("\x01")) for c in identity]
    digest = F.md5(F.concat_ws("\x02", F.lit(str(seed)), *ids, F.md5(F.coalesce(F.col(text), F.lit("\x01")))))
    # 52 bits, so that u is never 0 or 1.
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    drawn = {"_source": F.col(source), "size": word_count(F.col(text)), "_weight": weight, "_key": -F.log(u) / weight}
    drawn = [column.alias(name) for name, column in drawn.items()]
    # Without the texts: for the sums per source and bin.
    narrow = staged(docs.select(*drawn), "mix-sizes")
    totals = narrow.groupBy(F.col("_source").alias("source")).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows"), F.avg("_weight").alias("_mean")
    )
    targets = source_targets(totals.select("source", "source_size"), weights, share, most)
    joined = targets.join(totals.select("source", "_rows", "_mean"), targets["source"].eqNullSafe(totals["source"]))
    plan = joined.select(targets["source"].alias("_s"), "source_size", "target", "_rows", "_mean")
    # A row per source and a row per bin: stored, so that Spark knows their sizes when it
    # chooses between a broadcast and a shuffle join.
    plan = staged(plan, "mix-plan")
    binned = _bins(narrow.join(plan, narrow["_source"].eqNullSafe(plan["_s"])))
    sums = binned.groupBy("_source", "_bin").agg(F.sum("size").alias("_bin_size"))
    in_source = Window.partitionBy("_source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_bin_size").over(in_source), F.lit(0)).alias("_start")
    starts = staged(sums.select(F.col("_source").alias("_s2"), F.col("_bin").alias("_b"), start), "mix-bins")

    # The input's own columns travel as one struct, so no name of theirs is in the way.
    order = [F.col(c).alias(f"_id{i}") for i, c in enumerate(identity)]
    sized = docs.select(F.struct(*kept).alias("_row"), *drawn, *order, F.substring(digest, 14, 19).alias("_tie"))
    rows = _bins(sized.join(plan, sized["_source"].eqNullSafe(plan["_s"])))
    rows = rows.join(starts, rows["_s"].eqNullSafe(starts["_s2"]) & (rows["_bin"] == starts["_b"]))
    places = [f"_id{i}" for i in range(len(identity))]
    in_bin = Window.partitionBy("_s", "_bin").orderBy("_key", *places, "_tie")
    before = F.coalesce(F.sum("size").over(in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    budget = F.floor(F.col("target") - epochs * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("_start") - before))
    taken = (epochs * F.col("size") + part).cast("long")
    return rows.select("_row.*", "size", "source_size", "target", taken.alias("taken"))


def _bins(rows: DataFrame) -> DataFrame:
    """Add _bin, by the key, from the source's _rows and _mean weight."""
    # The keys of a source spread about evenly over (0, 1) by this.
    spread = F.lit(1.0) - F.exp(-F.col("_key") * F.col("_mean"))
    bins = F.greatest(F.lit(1.0), F.ceil(F.col("_rows") / F.lit(BIN_ROWS)))
    return rows.withColumn("_bin", F.least(F.floor(spread * bins), bins - 1).cast("long"))
