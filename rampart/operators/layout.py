"""Order of rows that keeps equal and near values of several columns together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cuts come from about so many rows; they only decide where a row is stored.
SAMPLE_ROWS = 20_000


def cuts(df: DataFrame, columns: list[str], bits: int, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Per column at most ``2 ** bits - 1`` values that cut a sample into equal parts."""
    share = min(1.0, sample_rows / max(1, df.count()))
    rows = df.select(*columns).sample(share, seed=1).limit(2 * sample_rows).collect()
    found = {}
    for name in columns:
        values = sorted(row[name] for row in rows if row[name] is not None)
        places = (len(values) * k // 2**bits for k in range(1, 2**bits))
        found[name] = sorted({values[p] for p in places}) if values else []
    return found


def rank(column: str, bounds: list, bits: int) -> Column:
    """Which part of ``2 ** bits`` a value falls in, by a tree of comparisons; NULL: 0."""
    parts = len(bounds) + 1

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low * 2**bits // parts)
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(bounds[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(bounds))


def interleaved(bounds: dict[str, list], bits: int) -> Column:
    """The place of a row on a space-filling curve: the ranks of all columns with their
    bits interleaved, the highest first."""
    ranks = [rank(name, own, bits) for name, own in bounds.items()]
    if len(ranks) * bits > 62:
        raise ValueError("at most 62 bits in all")
    taken = []
    for bit in range(bits):
        for i, own in enumerate(ranks):
            place = bit * len(ranks) + len(ranks) - 1 - i
            taken.append(F.shiftleft(F.shiftright(own, bit).bitwiseAND(F.lit(1)).cast("long"), place))
    return reduce(lambda a, b: a.bitwiseOR(b), taken)
