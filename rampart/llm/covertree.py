"""Exact top-k inner products by a dual-tree search over cover trees.

All vectors become integers, floor(256 * x).  Candidates are dealt to blocks around pivots
(at most ``MOST_BLOCKS`` blocks; a pivot with many rows has several), queries too.  A block
is indexed by a cover tree: a node's points lie within its covering radius; its children's
centres are the points furthest from each other, until half the radius covers all points
or there are ``CHILDREN``.  Pairs of nodes are pruned if no point of the one can beat the worst
kth score of the queries in the other:

    max q.c <= qc.cc + |qc| * rc + |cc| * rq + rq * rc

The same bound on whole blocks says which pairs of blocks are searched at all, once every
query block has been searched against its most promising candidate block.

Rows: vectors that are NULL or hold a NULL or non-finite component, and rows without an id,
take no part.  A query is not compared with rows of its own id.  Vectors of different
lengths are not compared.  Rows of one id count each,
also equal ones, as queries too; ties go to the smaller id.  Other
columns are not used.  Without queries or candidates the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rampart.llm.common import staged, staged_twice
from rampart.llm.pq import usable

BLOCK = 2_048
MOST_BLOCKS = 8_192
LEAF = 128
CHILDREN = 8
_PIVOT_SAMPLE = 8_192


@dataclass
class Node:
    rows: np.ndarray
    center: np.ndarray
    norm: float
    radius: float
    children: list["Node"]


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree over the rows of ``points`` (not empty)."""

    def node(rows: np.ndarray, center: int) -> Node:
        distance = np.sqrt(((points[rows] - points[center]) ** 2).sum(axis=1))
        radius = float(distance.max())
        made = Node(rows, points[center], float(np.sqrt(points[center] @ points[center])), radius, [])
        if len(rows) <= leaf or radius == 0:
            return made
        # Centres far apart; each point goes to its nearest one.
        nearest, own, centers = distance.copy(), np.full(len(rows), center), 1
        while nearest.max() > radius / 2 and centers < CHILDREN:
            far = rows[int(nearest.argmax())]
            gap = np.sqrt(((points[rows] - points[far]) ** 2).sum(axis=1))
            closer = gap < nearest
            nearest[closer], own[closer] = gap[closer], far
            centers += 1
        made.children = [node(rows[own == c], c) for c in np.unique(own)]
        return made

    return node(np.arange(len(points)), 0)


def _bound(a: Node, b: Node) -> float:
    exact = float(a.center @ b.center) + a.norm * b.radius + b.norm * a.radius + a.radius * b.radius
    return exact + 1e-9 * (1 + abs(exact))


class _Best:
    """The k best candidates of each query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.scores = np.full((queries, k), -np.inf)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` per row of ``rows`` and candidate; -inf for 'not a candidate'."""
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_ids = np.concatenate([self.ids[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)

    def worst(self, rows: np.ndarray) -> float:
        return float(self.scores[rows, -1].min())


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products as doubles where these are exact, else as Python
    integers in object form."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2**53:
        return a @ b.T
    return a.astype(object) @ b.T.astype(object)


def dual_search(
    queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None
) -> _Best:
    """The k greatest inner products of each query among ``points`` of another id.

    ``floor``: scores that each query is known to reach k times elsewhere; what lies below
    may be left out.
    """
    best = _Best(len(queries), k)
    floor = np.full(len(queries), -np.inf) if floor is None else floor
    left, right = cover_tree(queries), cover_tree(points)
    stack = [(_bound(left, right), left, right)]
    while stack:
        bound, a, b = stack.pop()
        if bound < float(np.maximum(best.scores[a.rows, -1], floor[a.rows]).min()):
            continue
        if not a.children and not b.children:
            scores = _products(queries[a.rows], points[b.rows]).astype(np.float64)
            scores = np.where(query_ids[a.rows][:, None] == ids[b.rows][None], -np.inf, scores)
            # Only queries that one of these could help are merged.
            helped = scores.max(axis=1) >= best.scores[a.rows, -1]
            if helped.any():
                best.add(a.rows[helped], scores[helped], ids[b.rows])
            continue
        if b.children and (not a.children or b.radius >= a.radius):
            pairs = [(_bound(a, child), a, child) for child in b.children]
        else:
            pairs = [(_bound(child, b), child, b) for child in a.children]
        # The most promising pair is searched first.
        stack.extend(sorted(pairs, key=lambda pair: pair[0]))
    return best


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.float64) for x in column])


def _blocks(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (vec_id, vector, width) with a block number, and per block its width, mean
    and radius around the mean."""
    spark = rows.sparkSession
    total = rows.count()
    size = max(BLOCK, -(-total // (MOST_BLOCKS // 2)))
    count = max(1, min(_PIVOT_SAMPLE, -(-total // size)))
    draw = F.xxhash64("vec_id", "vector", F.lit(4))
    picked = rows.where(F.pmod(draw, F.lit(max(1, total // (4 * count)))) == 0).select("vector").limit(count).toPandas()
    # Pivots by width; rows of a width without pivots share one cell.
    pivots: dict[int, np.ndarray] = {}
    for width in {len(x) for x in picked["vector"]}:
        pivots[width] = np.stack([np.asarray(x, np.float64) for x in picked["vector"] if len(x) == width])
    shared = spark.sparkContext.broadcast(pivots)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell = np.zeros(len(frame), np.int32)
            for width, places in frame.groupby("width").indices.items():
                centers = shared.value.get(width)
                if centers is not None:
                    points = _matrix(frame["vector"].iloc[places])
                    cell[places] = ((centers**2).sum(axis=1) - 2 * points @ centers.T).argmin(axis=1)
            yield frame.assign(cell=cell)

    dealt = staged(rows.mapInPandas(assign, "vec_id long, vector array<double>, width int, cell int"), f"{name}-cells")
    sizes = dealt.groupBy("width", "cell").agg(F.count("*").alias("n")).select("width", "cell", F.ceil(F.col("n") / size).cast("int").alias("of"))
    part = F.pmod(F.xxhash64("vec_id", F.lit(6)), F.col("of")).cast("int")
    sizes = staged(sizes, f"{name}-sizes")
    blocks = dealt.join(sizes, ["width", "cell"]).select(
        "vec_id", "vector", "width", F.concat_ws("-", "width", "cell", part).alias(name)
    )
    blocks = staged(blocks, f"{name}-blocks")

    def summary(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        points = _matrix(frame["vector"])
        mean = points.mean(axis=0)
        radius = float(np.sqrt(((points - mean) ** 2).sum(axis=1)).max())
        return pd.DataFrame({name: [key[0]], "width": [len(mean)], "mean": [mean], "radius": [radius]})

    schema = f"{name} string, width int, mean array<double>, radius double"
    return blocks, staged(blocks.groupBy(name).applyInPandas(summary, schema), f"{name}-summary")


def _bounds(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (query_block, block, bound) of all pairs of blocks of one width.

    ``right`` has at most ``MOST_BLOCKS`` rows, so its broadcast is bounded.
    """
    spark = left.sparkSession
    shared = spark.sparkContext.broadcast(right.toPandas())

    def pair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for own in frame.itertuples():
                other = shared.value[shared.value["width"] == own.width]
                if not len(other):
                    continue
                means, mean = _matrix(other["mean"]), np.asarray(own.mean)
                norms, radii = np.sqrt((means**2).sum(axis=1)), other["radius"].to_numpy()
                bound = means @ mean + np.sqrt(mean @ mean) * radii + norms * own.radius + own.radius * radii
                bound += 1e-9 * (1 + np.abs(bound))
                yield pd.DataFrame({"query_block": own.query_block, "block": other["block"].to_numpy(), "bound": bound})

    return left.mapInPandas(pair, "query_block string, block string, bound double")


def _search(pairs: DataFrame, queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Top k of each query within each pair of blocks."""
    pairs, again = staged_twice(pairs.select("query_block", "block"), "block-pairs")
    left, right = queries.join(pairs, "query_block"), points.join(again, "block")
    schema = "query_id long, row long, vec_id long, score long"

    def search(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "row", "vec_id", "score")})
        q, p = _matrix(asked["vector"]), _matrix(held["vector"])
        query_ids, ids = asked["vec_id"].to_numpy(), held["vec_id"].to_numpy()
        best = dual_search(q, query_ids, p, ids, k, asked["floor"].to_numpy(np.float64))
        a, b = np.nonzero(np.isfinite(best.scores))
        return pd.DataFrame({
            "query_id": query_ids[a], "row": asked["row"].to_numpy()[a], "vec_id": best.ids[a, b], "score": best.scores[a, b].astype(np.int64),
        })

    keys = ["query_block", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(search, schema)


def top_k(vectors: DataFrame, *, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of each query: a row
    whose vec_id is divisible by ``every``."""
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * 256).cast("double"))
    rows = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long"), whole.alias("vector")).withColumn("width", F.size("vector")).where("width > 0")
    points, summaries = _blocks(rows, "block")
    # Equal query rows are searched once; each has the neighbours found, in the end.
    own = rows.where(F.pmod("vec_id", F.lit(every)) == 0).groupBy("vec_id", "vector", "width")
    own, again = staged_twice(own.agg(F.count("*").cast("int").alias("copies")), "queries")
    queries, query_summaries = _blocks(own.drop("copies"), "query_block")
    row = F.xxhash64("vec_id", "vector").alias("row")
    queries = queries.withColumn("row", row)
    repeated = again.where("copies > 1").select(F.col("vec_id").alias("query_id"), row, "copies")
    bounds = staged(_bounds(query_summaries, summaries), "bounds")
    best = bounds.groupBy("query_block").agg(F.max(F.struct("bound", "block")).alias("top")).select("query_block", F.col("top.block").alias("block"))
    best = staged(best, "best-blocks")
    first = staged(_search(best, queries.withColumn("floor", F.lit(float("-inf"))), points, k), "first")
    # A query's kth score so far; with fewer than k there is none.
    kth = first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    floor = F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))
    asked = staged(queries.join(kth.select("row", "kth"), "row", "left").select(*queries.columns, floor.alias("floor")), "floors")
    worst = asked.groupBy("query_block").agg(F.min("floor").alias("worst"))
    rest = bounds.join(best, ["query_block", "block"], "left_anti").join(worst, "query_block").where("bound >= worst")
    second = _search(rest, asked, points, k)
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    ranked = first.union(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked = ranked.join(repeated, ["query_id", "row"], "left")
    copies = F.array_repeat(F.lit(0), F.coalesce("copies", F.lit(1)))
    return ranked.select("query_id", "rank", "vec_id", "score", F.explode(copies).alias("_copy")).drop("_copy")
