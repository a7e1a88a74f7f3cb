"""Near-duplicate vectors by product quantisation over coarse inverted lists.

Vectors link if they have equal labels and their cosine reaches the threshold.

1. Equal vectors of one label are one node with a count, so copies are compared once.
2. Coarse centroids and, on the residuals, one codebook per subspace are fitted on a
   sample of at most ``SAMPLE`` vectors; all vectors are assigned and coded.
3. A vector probes every list that could hold a partner: with r the chord of the threshold
   on the unit sphere, a list is skipped only if the vector is further than r beyond the
   plane between its own centroid and the list's.  No partner can be there.
4. In a list, distances to the codes come from lookup tables; a code's own error is stored,
   so a candidate is dropped only if even the exact distance must exceed r.  The rest are
   compared by cosine in double precision.
5. A unit of work is a block of a list and a block of its probing vectors.  It returns, per
   node, the number of partners (copies counted) and the least node that it hangs
   together with, not the pairs.

Rows: vectors that are NULL, zero or hold a NULL or non-finite component, or have no label,
link with nothing, also not with copies.  Vectors of different lengths do not link.
Repeated ids are rows of their own.  A NULL id gets the least id that its vector reaches.
Other columns are not used.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import staged, staged_twice
from rampart.llm.components import attach, components, least_members

SAMPLE = 8_192
LIST_ROWS = 1_024
MOST_LISTS = 4_096
SUBSPACES = 8
CODES = 256
BLOCK = 1_024
_SLACK = 1e-6
_DRAW = (1 << 62) - 1


def usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(fine, F.lit(False))


def _k_means(points: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(3)
    centers = points[rng.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(rounds):
        own = _nearest(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(centers))[:, None]
        centers = np.where(sizes > 0, sums / np.maximum(sizes, 1), centers)
    return centers


def _nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    norms = (centers**2).sum(axis=1)
    parts = [(norms - 2 * points[i : i + 4096] @ centers.T).argmin(axis=1) for i in range(0, len(points), 4096)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class Quantiser:
    """Coarse centroids and residual codebooks for unit vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.centers = _k_means(sample, lists)
        own = _nearest(sample, self.centers)
        parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.parts = parts
        residual = sample - self.centers[own]
        self.books = [_k_means(residual[:, p], CODES) for p in parts]

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of each vector."""
        own = _nearest(unit, self.centers)
        residual = unit - self.centers[own]
        codes = np.stack([_nearest(residual[:, p], book) for p, book in zip(self.parts, self.books)], 1)
        error = np.zeros(len(unit))
        for k, (p, book) in enumerate(zip(self.parts, self.books)):
            error += ((residual[:, p] - book[codes[:, k]]) ** 2).sum(axis=1)
        return own, codes.astype(np.uint8), np.sqrt(error)

    def probes(self, unit: np.ndarray, own: np.ndarray, radius: float) -> list[np.ndarray]:
        """The lists that can hold a vector within ``radius``, per vector."""
        norms = (self.centers**2).sum(axis=1)
        found = []
        for first in range(0, len(unit), 512):
            rows, mine = unit[first : first + 512], own[first : first + 512]
            # Squared distances but for the vector's own norm.
            square = norms - 2 * rows @ self.centers.T
            apart = norms + norms[mine, None] - 2 * self.centers[mine] @ self.centers.T
            near = square - square[np.arange(len(rows)), mine][:, None] <= 2 * (radius + _SLACK) * np.sqrt(np.maximum(apart, 0)) + _SLACK
            places, cells = np.nonzero(near)
            found += np.split(cells, np.searchsorted(places, np.arange(1, len(rows))))
        return found

    def distances(self, unit: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Distances of vectors (rows) to coded vectors of list ``which`` (columns)."""
        residual = unit - self.centers[which]
        total = np.zeros((len(unit), len(codes)))
        for k, (p, book) in enumerate(zip(self.parts, self.books)):
            x = residual[:, p]
            lookup = (x**2).sum(axis=1)[:, None] - 2 * x @ book.T + (book**2).sum(axis=1)
            total += lookup[:, codes[:, k]]
        return np.sqrt(np.maximum(total, 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two near their greatest component: an exact step, but for
    components too small to count, after which no square over- or underflows."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _units(rows: np.ndarray) -> np.ndarray:
    rows = _scaled(rows)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def near_vectors(
    vectors: DataFrame, *, threshold: float = 0.98, sample_rows: int = SAMPLE, list_rows: int = LIST_ROWS
) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id and
    kept."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label")
    real = usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull()
    node = F.when(F.coalesce(real, F.lit(False)), F.xxhash64("label", F.size("embedding"), "embedding"))
    rows = staged(rows.withColumn("node", node), "vectors")
    good = rows.where("node IS NOT NULL")
    same = ["label", "embedding"]
    nodes = good.groupBy("node", *same).agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    nodes = staged(nodes.withColumn("width", F.size("embedding")), "vector-nodes")
    labels = nodes.groupBy("width", "label").agg(F.count("*").alias("rows"))
    shape = labels.groupBy("width").agg(F.sum("rows"), F.max("rows")).collect()
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    found = None
    for width, count, most in shape:
        part = nodes.where(F.col("width") == width)
        share = min(1.0, sample_rows / count)
        draw = F.xxhash64("node", F.lit(2)).bitwiseAND(F.lit(_DRAW)) <= F.lit(int(share * _DRAW))
        picked = part.where(draw).select("embedding").limit(2 * sample_rows).toPandas()
        if not len(picked):
            picked = part.select("embedding").limit(1).toPandas()
        # Enough for the label with the most vectors.
        lists = int(min(MOST_LISTS, max(1, round(most / list_rows))))
        model = Quantiser(_units(_matrix(picked["embedding"])), lists)
        own = _linked(part, spark.sparkContext.broadcast(model), threshold, radius)
        found = own if found is None else found.union(own)
    if found is None:
        lonely = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return lonely.withColumn("kept", F.col("vec_id").isNotNull())
    found = staged(found, "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    info = nodes.select("node", "least", "copies").join(counts, "node", "left").join(groups, "node", "left")
    info = staged(info.withColumn("group", F.coalesce("component", "node")), "vector-info")
    total = info.count()
    least = staged(info.groupBy("group").agg(F.min("least").alias("component_id"), F.count("*").alias("n_rows")), "vector-groups")
    named = attach(info.select("node", "copies", "links", "group"), least, "group", total)
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long")
    per_node = staged(named.select("node", links.alias("n_links"), "component_id", F.col("copies").alias("n_rows")), "vector-ids")
    linked = attach(good.select("vec_id", "node"), per_node, "node", rows.count()).select("vec_id", "n_links", "component_id")
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _linked(nodes: DataFrame, model, threshold: float, radius: float) -> DataFrame:
    """Rows (node, links, root), several per node; they add up."""
    coded_schema = "node long, label string, embedding array<double>, copies long, cell int, codes binary, error double, probes array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("embedding")
            unit = _units(column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            own, codes, error = model.value.encode(unit)
            probes = model.value.probes(unit, own, radius)
            columns = [
                batch.column("node"), batch.column("label"), column, batch.column("copies"), pa.array(own.astype(np.int32)),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(probes, pa.list_(pa.int32())),
            ]
            names = [x.split()[0] for x in coded_schema.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    coded = nodes.select("node", F.col("label").cast("string"), "embedding", "copies").mapInArrow(encode, coded_schema)
    coded, again = staged_twice(coded, "vector-codes")
    cells = coded.groupBy("label", "cell").agg(F.count("*").alias("rows"))
    asked = again.select("label", F.explode("probes").alias("cell")).groupBy("label", "cell").agg(F.count("*").alias("asking"))
    # One row per label and list.
    plan = cells.join(asked, ["label", "cell"]).select(
        "label", "cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("of_rows"), F.ceil(F.col("asking") / BLOCK).cast("int").alias("of_asking")
    )
    plan, plan2 = staged_twice(plan, "vector-plan")

    def block(count: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    held = coded.select("node", "label", "cell", "embedding", "copies", "codes", "error").join(plan, ["label", "cell"])
    held = held.withColumn("i", block("of_rows", 1)).withColumn("j", every("of_asking")).drop("of_rows", "of_asking")
    asking = again.select("node", "label", "embedding", F.explode("probes").alias("cell")).join(plan2, ["label", "cell"])
    asking = asking.withColumn("j", block("of_asking", 2)).withColumn("i", every("of_rows")).drop("of_rows", "of_asking")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
        if not len(left) or not len(right):
            return empty
        x, y = _scaled(_matrix(right["embedding"])), _scaled(_matrix(left["embedding"]))
        ux, uy = _units(x), _units(y)
        codes = np.stack([np.frombuffer(c, np.uint8) for c in left["codes"]])
        error, copies = left["error"].to_numpy(), left["copies"].to_numpy()
        asking_nodes, nodes = right["node"].to_numpy(), left["node"].to_numpy()
        us, vs, ns = [], [], []
        for start in range(0, len(ux), 256):
            part = ux[start : start + 256]
            near = model.value.distances(part, int(left["cell"].iloc[0]), codes) - error <= radius + _SLACK
            a, b = np.nonzero(near)
            a += start
            other = asking_nodes[a] != nodes[b]
            a, b = a[other], b[other]
            dots = np.einsum("ij,ij->i", x[a], y[b])
            norms = np.sqrt((x[a] ** 2).sum(axis=1) * (y[b] ** 2).sum(axis=1))
            linked = dots / norms >= threshold
            a, b = a[linked], b[linked]
            us.append(asking_nodes[a])
            vs.append(nodes[b])
            ns.append(copies[b])
        u, v, n = np.concatenate(us), np.concatenate(vs), np.concatenate(ns)
        if not len(u):
            return empty
        every_node, roots = least_members(u, v)
        links = np.bincount(np.searchsorted(every_node, u), n, minlength=len(every_node)).astype(np.int64)
        return pd.DataFrame({"node": every_node, "links": links, "root": roots})

    keys = ["label", "cell", "i", "j"]
    return held.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(compare, "node long, links long, root long")
