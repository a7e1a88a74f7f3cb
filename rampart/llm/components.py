"""Connected components of a graph of links by alternating large-star and small-star.

Nodes are longs.  A large-star step links a node's greater neighbours to the least node of
its neighbourhood, a small-star step its smaller ones; in the end every node hangs at the
least node of its component.  The links are written after each step, so no lineage or plan
grows and a lost executor costs a step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import staged

# A key with more than this share of all rows is joined by a broadcast of its one row.
HOT_SHARE = 1 / 1000
HOT_ROWS = 256


def attach(rows: DataFrame, keyed: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``keyed``, which has one row per ``key`` and says in ``n_rows``
    how many rows of ``rows`` have it (at least roughly).

    Keys with more than 1/1000 of all rows are at most 1000, a proven bound: their rows of
    ``keyed`` are broadcast, so a hot key stays where it is.  All others are shuffled; without
    a hot key that is all.  ``keyed`` is read several times, so it should be a staged table:
    a longer plan would stand several times in the result's, for the driver to work through.
    """
    limit = max(HOT_ROWS, int(total * HOT_SHARE))
    names = [c for c in keyed.columns if c not in (key, "n_rows")]
    kept = rows.columns
    if (keyed.agg(F.max("n_rows")).first()[0] or 0) <= limit:
        return rows.join(keyed.select(key, *names), key).select(*kept, *names)
    hot = keyed.where(F.col("n_rows") > limit).select(key, *names)
    cold = keyed.where(F.col("n_rows") <= limit).select(key, *names)
    mark = F.lit(True).alias("_hot")
    seen = rows.join(F.broadcast(hot.select(key, F.struct(*names, mark).alias("_found"))), key, "left")
    first = seen.where(F.col("_found").isNotNull()).select(*kept, *(F.col("_found")[n].alias(n) for n in names))
    rest = seen.where(F.col("_found").isNull()).select(*kept)
    return first.unionByName(rest.join(cold, key).select(*kept, *names))


def _star(links: DataFrame, total: int) -> DataFrame:
    """Rows (u, v, m): each link in both directions with the least of u and its
    neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n_rows"))
    return attach(both, staged(least, "least"), "u", 2 * total)


def _large_star(links: DataFrame, total: int) -> DataFrame:
    far = _star(links, total).where("v > u")
    return far.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame, total: int) -> DataFrame:
    """``links`` have u > v."""
    least = staged(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n_rows")), "least")
    near = attach(links, least, "u", total).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return near.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes that are in a link (u, v) of two nodes;
    component is the least node of the component."""
    oriented = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = staged(oriented, "links")
    state = _state(current)
    while state[0]:
        far = staged(_large_star(current, state[0]), "links")
        current = staged(_small_star(far, state[0]), "links")
        before, state = state, _state(current)
        if before == state:
            break
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )


def _state(links: DataFrame) -> tuple[int, int, int]:
    """Count and two hash sums: equal when a step changed nothing."""
    total = F.count("*"), *(F.sum(F.xxhash64("u", "v", F.lit(i)).cast("decimal(38,0)")) for i in (1, 2))
    return tuple(int(x or 0) for x in links.agg(*total).first())


def least_members(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links and the least node that each hangs together with: what one
    task can say about its own links in a row per node."""
    nodes, places = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return nodes, nodes[root]
        root = new
