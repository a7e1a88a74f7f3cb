"""K-means by Lloyd's rounds, sharded by dimension, in exact integers.

A vector's components become integers floor(scale * x).  Vectors are laid out in chunks, and
each chunk is cut into blocks of ``BLOCK`` columns; the centroids are cut the same way.

1. A task of a column block computes the exact partial distances of a chunk's slice to
   the centroids' slices of its own block.
2. The partial distances of a chunk are added over its blocks, and the nearest centroid is
   taken (ties: the smaller number).
3. The labels go back to the column blocks, each of which updates its own slice of the
   centroids: floor(sum / count) per component; an empty cluster keeps its centroid.

Slices stay where they are: they are stored once, bucketed by chunk and block, so a round
shuffles partial distances and labels, not vectors.  Chunks hold rows as they come, so
equal vectors are no hot group.  The centroids of each round are a table of one row per
block; no task or driver holds all of them unless their size is under ``BROADCAST_BYTES``.

The first centroids are the vectors with the smallest sha256 of ``seed:vec_id`` (ties, as of
repeated ids: the smaller vector first; NULL ids last).  With fewer vectors than clusters
there are as many centroids as vectors.

Rows: vectors that are NULL, of another width, or hold a NULL or non-finite component are
left out.  Repeated rows and ids, and NULL ids, are rows of their own.  A component of
65,536 or more at scale 1024 (2^26 after scaling) is an error, as its distances need not
fit a long.  Other columns are not used.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rampart.functions.session import fresh_path
from rampart.llm.common import staged
from rampart.llm.pq import usable

BLOCK = 16
CHUNK = 1_024
# Partial distances of one chunk and block take at most so many bytes.
PARTIAL_BYTES = 16 << 20
BROADCAST_BYTES = 16 << 20
SALTS = 16
GREATEST = 1 << 26

_SLICES = "chunk long, block int, data binary, vec_ids array<long>"
_OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def partial_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``x`` to rows of ``c`` (integers below 2^26)."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * x.shape[1] * top * top < 1 << 53:
        # All terms and sums are integers that doubles hold exactly.
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.empty((len(x), len(c)), np.int64)
    for k in range(len(c)):
        apart = x.astype(np.int64) - c[k].astype(np.int64)
        out[:, k] = (apart * apart).sum(axis=1)
    return out


def _sliced(rows: DataFrame, width: int, scale: int, chunk_rows: int) -> DataFrame:
    """Chunks of vectors (vec_id, embedding) cut into column blocks."""
    cuts = range(0, width, BLOCK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            scaled = np.floor(scale * flat)
            if np.abs(scaled).max(initial=0) >= GREATEST:
                raise ValueError(f"a component times {scale} is {GREATEST} or more")
            whole = scaled.astype(np.int32)
            ids = batch.column("vec_id")
            for first in range(0, batch.num_rows, chunk_rows):
                part, own = whole[first : first + chunk_rows], ids.slice(first, chunk_rows).to_pylist()
                columns = [
                    pa.array([number] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int32()),
                    pa.array([np.ascontiguousarray(part[:, c : c + BLOCK]).tobytes() for c in cuts], pa.binary()),
                    pa.array([own if c == 0 else None for c in cuts], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SLICES.split(", ")])
                number += 1

    return rows.mapInArrow(cut, _SLICES)


def _beside(slices: DataFrame, centers: DataFrame, size: int) -> DataFrame:
    """Slices with the centroids' slices of their block."""
    if size <= BROADCAST_BYTES:
        return slices.join(F.broadcast(centers), "block")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salted = slices.withColumn("_salt", F.pmod("chunk", F.lit(SALTS)))
    return salted.join(centers.withColumn("_salt", salts), ["block", "_salt"]).drop("_salt")


def _labels(slices: DataFrame, centers: DataFrame, clusters: int, size: int) -> DataFrame:
    """chunk, labels and distances (binary) of every chunk."""

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                c = np.frombuffer(batch.column("centers")[row].as_buffer(), np.int64).reshape(clusters, -1)
                x = np.frombuffer(batch.column("data")[row].as_buffer(), np.int32).reshape(-1, c.shape[1])
                found = partial_distances(x, c).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column("chunk").slice(row, 1), pa.array([found], pa.binary())], names=["chunk", "partial"]
                )

    def nearest(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, np.int64) for x in frame["partial"]).reshape(-1, clusters)
        labels = total.argmin(axis=1)
        found = total[np.arange(len(total)), labels]
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "labels": [labels.astype(np.int32).tobytes()], "distances": [found.tobytes()]})

    beside = _beside(slices.select("chunk", "block", "data"), centers, size)
    partial = beside.select("chunk", "data", "centers").mapInArrow(distances, "chunk long, partial binary")
    return partial.groupBy("chunk").applyInPandas(nearest, "chunk long, labels binary, distances binary")


def _moved(slices: DataFrame, labels: DataFrame, centers: DataFrame, clusters: int, blocks: int) -> DataFrame:
    """The centroids' slices (block, centers) after an update."""
    sums_schema = "block int, cluster int, place int, count long, total decimal(20,0)"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One sum per block of the task; 2^26 * rows stays below 2^63 for 10^11 rows.
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                own = np.frombuffer(batch.column("labels")[row].as_buffer(), np.int32)
                x = np.frombuffer(batch.column("data")[row].as_buffer(), np.int32).reshape(len(own), -1)
                block = batch.column("block")[row].as_py()
                if block not in totals:
                    totals[block] = np.zeros((clusters, x.shape[1] + 1), np.int64)
                for k in np.unique(own):
                    mine = x[own == k]
                    totals[block][k, 0] += len(mine)
                    totals[block][k, 1:] += mine.sum(axis=0, dtype=np.int64)
        for block, total in totals.items():
            used = np.flatnonzero(total[:, 0])
            width = total.shape[1] - 1
            columns = [
                pa.array([block] * (len(used) * width), pa.int32()), pa.array(np.repeat(used, width).astype(np.int32)),
                pa.array(np.tile(np.arange(width, dtype=np.int32), len(used))), pa.array(np.repeat(total[used, 0], width)),
                pa.array([Decimal(int(v)) for v in total[used, 1:].reshape(-1)], pa.decimal128(20, 0)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in sums_schema.split(", ")])

    def update(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        kept = np.frombuffer(old["centers"].iloc[0], np.int64).reshape(clusters, -1).copy()
        for cluster, place, count, total in zip(new["cluster"], new["place"], new["count"], new["total"]):
            kept[cluster, place] = int(total) // int(count)
        return pd.DataFrame({"block": [old["block"].iloc[0]], "centers": [kept.tobytes()]})

    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    to_block = labels.select("chunk", "labels", every).hint("shuffle_hash")
    beside = slices.select("chunk", "block", "data").join(to_block, ["chunk", "block"])
    added = beside.select("block", "data", "labels").mapInArrow(sums, sums_schema)
    added = added.groupBy("block", "cluster", "place").agg(F.sum("count").alias("count"), F.sum("total").alias("total"))
    moved = added.groupBy("block").cogroup(centers.groupBy("block"))
    return moved.applyInPandas(update, "block int, centers binary")


def cluster_vectors(
    vectors: DataFrame, *, width: int, scale: int, clusters: int, rounds: int, seed: int = 3, chunk_rows: int = CHUNK
) -> DataFrame:
    """Per vector of ``vectors`` (vec_id, embedding) that takes part: vec_id, cluster, its
    squared distance, cluster_inertia and inertia (distances summed over the cluster and
    over all) and centroid_sha256 (of the centroid's components, joined by commas)."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.where(usable(F.col("embedding")) & (F.size("embedding") == width))
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(digest.alias("digest"), whole.alias("x")).orderBy(F.col("digest").asc_nulls_last(), "x").limit(clusters)
    # ``clusters`` rows.
    first = np.array([r.x for r in first.collect()], np.int64).reshape(-1, width)
    clusters = len(first)
    if not clusters:
        return spark.createDataFrame([], _OUT)
    blocks = -(-width // BLOCK)
    chunk_rows = max(1, min(chunk_rows, PARTIAL_BYTES // (8 * clusters)))
    name = f"slices_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = _sliced(rows, width, scale, chunk_rows).repartition(buckets, "chunk", "block")
    path = fresh_path(spark, "slices")
    cut.write.format("parquet").bucketBy(buckets, "chunk", "block").option("path", path).saveAsTable(name)
    try:
        slices = spark.table(name)
        starts = [(b, bytearray(np.ascontiguousarray(first[:, b * BLOCK : (b + 1) * BLOCK]).tobytes())) for b in range(blocks)]
        centers = staged(spark.createDataFrame(starts, "block int, centers binary"), "centers")
        size = 8 * clusters * width
        for _ in range(rounds):
            labels = _labels(slices, centers, clusters, size)
            centers = staged(_moved(slices, labels, centers, clusters, blocks), "centers")
        last = _labels(slices, centers, clusters, size)
        ids = slices.where("block = 0").select("chunk", "vec_ids")
        found = staged(ids.join(last, "chunk").select("vec_ids", "labels", "distances").mapInArrow(_rows, "vec_id long, cluster int, distance long"), "clustered")
    finally:
        # The files stay in the shared folder, as of all staged tables.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    texts = centers.mapInPandas(lambda frames: _texts(frames, clusters), "cluster int, block int, text string")
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"])
    digests = texts.groupBy("cluster").agg(F.sha2(F.array_join(in_order, ","), 256).alias("centroid_sha256"))
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("cluster_inertia"))
    # One row per cluster.
    stats = staged(sums.join(digests, "cluster"), "clusters")
    inertia = stats.agg(F.sum("cluster_inertia")).first()[0]
    known = F.broadcast(stats) if clusters * 256 <= BROADCAST_BYTES else stats
    joined = found.join(known, "cluster")
    return joined.select(
        "vec_id",
        "cluster",
        "distance",
        F.col("cluster_inertia").cast("long"),
        F.lit(inertia).cast("long").alias("inertia"),
        "centroid_sha256",
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            labels = np.frombuffer(batch.column("labels")[row].as_buffer(), np.int32)
            distances = np.frombuffer(batch.column("distances")[row].as_buffer(), np.int64)
            columns = [batch.column("vec_ids")[row].values, pa.array(labels), pa.array(distances)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])


def _texts(frames: Iterator[pd.DataFrame], clusters: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for block, data in zip(frame["block"], frame["centers"]):
            part = np.frombuffer(data, np.int64).reshape(clusters, -1)
            texts = [",".join(map(str, row.tolist())) for row in part]
            yield pd.DataFrame({"cluster": np.arange(clusters, dtype=np.int32), "block": np.int32(block), "text": texts})
