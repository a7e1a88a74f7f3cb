"""Near-duplicate documents: MinHash signatures, banding, verification, components.

A document's set holds its distinct shingles of ``words`` words (with fewer words, the whole
sequence is one shingle; without words the set is empty and links with nothing).  A-Z are
in lower case.  Documents link if their sets' Jaccard similarity reaches the threshold.

1. Each document gets ``ROWS * BANDS`` minima under universal (multiply-shift) hashes, band
   keys, and a 128-bit fingerprint of its set.  Documents with equal sets are one node.
2. Nodes that share a band key are in one bucket; buckets of one node are dropped.
3. Each bucket's nodes are held against its hub: the node with the most company over all
   its buckets, so the likeliest middle of a group of copies.  Candidates are verified on
   signatures with a wide margin, then on the full sets; links join components.  Buckets
   within one component are done.
4. In a bucket that is left, every node outside the hub's component is compared with all
   nodes of other components: in small buckets by a join, in large ones block by block,
   signatures first, then exact set sizes by a matrix product.  A block returns the links
   that hold its nodes together, not pairs.  So every pair that shares a bucket is either
   in one component already or verified; none is cut off.

The chance that a pair at similarity 0.85 shares no bucket is (1 - 0.85^6)^32 < 1e-6, at
0.8 below 1e-4.

Rows: repeated rows, and rows with the same id, are documents of their own.  A NULL text is
an empty one.  A NULL id gets the least id that its document reaches (NULL if there is
none).  Other columns are not used.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import WORD, arrow_rows, lean, slices, staged
from rampart.llm.components import attach, components, least_members
from rampart.llm.urls import UPPER

WORDS, PERCENT = 5, 80
ROWS, BANDS = 6, 32
# Signatures estimate a similarity to within this, but for a chance below 1e-6.
MARGIN = 0.14
SMALL_BUCKET = 32
LEFT_BLOCK, RIGHT_BLOCK = 256, 1024
_COLUMNS = 4_096
# A row of two whole sets can take some 300 KB.
_PAIR_ROWS = 500
# At so many remembered word hashes the memory of a worker starts afresh.
MEMORY = 200_000
_SLICE = 400_000
_WORD = re.compile(WORD)
_LOWER = str.maketrans(UPPER, UPPER.lower())
_RNG = np.random.default_rng(20)
_A = _RNG.integers(0, 1 << 32, ROWS * BANDS, np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, ROWS * BANDS, np.uint32)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_SETS = "node long, other long, n_shingles long"


class _Hashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_HASHES = _Hashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    if len(_HASHES) > MEMORY:
        _HASHES.clear()
    found = []
    for text in texts:
        own = [_HASHES[w] for w in _WORD.findall(text.translate(_LOWER) if not text.islower() else text)]
        if not own:
            found.append(np.zeros(0, np.uint64))
            continue
        tokens = np.array(own, np.uint64)
        width = min(words, len(tokens))
        size = len(tokens) - width + 1
        total = np.full(size, width, np.uint64)
        for i in range(width):
            total = _mix(total * _M1 + tokens[i : i + size])
        found.append(np.unique(total))
    return found


def _identity(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit fingerprint of the set, as two signed longs."""
    digest = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 32-bit minima per set; no set is empty."""
    out = np.empty((len(sets), ROWS * BANDS), np.uint32)
    sizes = np.array([len(s) for s in sets])
    first = 0
    while first < len(sets):
        # Runs of sets that fit a processor's cache.
        last = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), 60_000)) + first)
        # 32 bits of a shingle are enough to draw minima; sets are verified on all 64.
        values = (np.concatenate(sets[first:last]) >> np.uint64(32)).astype(np.uint32)
        starts = np.append(0, np.cumsum(sizes[first:last]))[:-1]
        held = np.empty_like(values)
        for k in range(ROWS * BANDS):
            np.multiply(values, _A[k], out=held)
            np.add(held, _B[k], out=held)
            out[first:last, k] = np.minimum.reduceat(held, starts)
        first = last
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    rows = signature.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        key = _mix(key * _M1 + rows[:, :, i])
    return key.view(np.int64)


def with_nodes(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``docs`` with ``_node`` and ``_other``, the fingerprint of each row's set, and
    ``_shingles``, its size."""
    added = "_node long, _other long, _shingles long"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for _, texts in slices(batch, text, _SLICE):
                rows += [(*_identity(s), len(s)) for s in shingle_sets(texts, words)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, "_node", "_other", "_shingles"])

    return docs.mapInArrow(lean(mark), f"{schema}, {added}")


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, node, other, n_shingles, signature and band keys of every document; those
    of empty sets are NULL."""
    out = f"doc_id long, digest long, {_SETS}, signature binary, bands array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch, "text", _SLICE):
                sets = shingle_sets(texts, words)
                full = [s for s in sets if len(s)]
                signed = signatures(full)
                blobs, keys = [None] * len(sets), [None] * len(sets)
                own = iter(zip(signed, band_keys(signed).tolist()))
                for i, s in enumerate(sets):
                    if len(s):
                        row, keys[i] = next(own)
                        # 16 bits of a minimum tell sets apart well enough to estimate.
                        blobs[i] = row.astype(np.uint16).tobytes()
                node, other = zip(*map(_identity, sets))
                columns = [
                    batch.column("doc_id").slice(first, len(texts)), batch.column("digest").slice(first, len(texts)),
                    pa.array(node), pa.array(other),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(blobs, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "digest", "node", "other", "n_shingles", "signature", "bands"]
                )
        _HASHES.clear()

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), "text")
    return rows.mapInArrow(lean(sign), out)


def _told_apart(signed: DataFrame) -> DataFrame:
    """``signed`` with a column ``of_set``: ``node``, but another number for all but one of
    different sets whose ``node`` is equal by chance."""
    first = signed.groupBy("node").agg(F.min("other").alias("first"), F.max("other").alias("last"))
    clash = staged(first.where("first <> last").select(F.col("node").alias("_node"), "first"), "clashes")
    if clash.isEmpty():
        return signed.withColumn("of_set", F.col("node"))
    found = signed.join(clash, signed["node"] == clash["_node"], "left")
    of_set = F.when(F.col("first") < F.col("other"), F.xxhash64("node", "other")).otherwise(F.col("node"))
    return staged(found.select(*signed.columns, of_set.alias("of_set")), "told-apart")


def _node_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """of_set, signature and full set of the nodes of ``wanted`` (of_set, node, doc_id,
    digest, signature).  Documents are told by id and text, so many under one id (or none)
    meet only their own rows."""
    keyed = wanted.select(F.col("doc_id").alias("_wanted"), F.col("digest").alias("_digest"), "of_set", "node", "signature")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("digest"), "text")
    rows = rows.join(keyed, F.col("doc_id").eqNullSafe(F.col("_wanted")) & (F.col("digest") == F.col("_digest")))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, marks, numbers = batch.column("node").to_pylist(), batch.column("signature"), batch.column("of_set")
            for first, texts in slices(batch, "text", _SLICE):
                sets = shingle_sets(texts, words)
                # Of rows with one id, the one whose set it is.
                good = [i for i, s in enumerate(sets) if _identity(s)[0] == nodes[first + i]]
                places = pa.array([first + i for i in good], pa.int64())
                columns = [
                    numbers.take(places), marks.take(places),
                    pa.array([sets[i].tobytes() for i in good], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "signature", "shingles"])

    found = rows.select("node", "of_set", "signature", "text").mapInArrow(lean(collect), "node long, signature binary, shingles binary")
    return found.dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough."""

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("signature").alias(f"{name}_sig"), F.col("shingles").alias(f"{name}_set"))

    rows = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            columns = [batch.column(c) for c in ("u_sig", "v_sig", "u_set", "v_set")]
            for i in range(batch.num_rows):
                us, vs, a, b = (np.frombuffer(c[i].as_buffer(), np.uint16 if k < 2 else np.uint64) for k, c in enumerate(columns))
                if 100 * ((us == vs).mean() + MARGIN) < percent:
                    continue
                same = len(a) + len(b) - len(np.union1d(a, b))
                if 100 * same >= percent * (len(a) + len(b) - same):
                    good.append(i)
            taken = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("u").take(taken), batch.column("v").take(taken)], names=["u", "v"])

    return rows.mapInArrow(lean(verify), "u long, v long")


def _pairs(left: str, right: str) -> list:
    return [F.greatest(left, right).alias("u"), F.least(left, right).alias("v")]


def _block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links in large buckets (key, node, label, hub_label, others, n_rows).

    Nodes outside the hub's component are dealt to left blocks, all nodes to right blocks;
    each pair of blocks is a unit of bounded size.
    """
    other = F.col("label") != F.col("hub_label")
    of_left = F.ceil(F.col("others") / F.lit(LEFT_BLOCK)).cast("int")
    of_right = F.ceil(F.col("n_rows") / F.lit(RIGHT_BLOCK)).cast("int")

    def deal(count: Column) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(9)), count).cast("int")

    def every(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    left = members.where(other).select(
        "key", "node", "label", F.lit(True).alias("is_left"), deal(of_left).alias("i"), every(of_right).alias("j")
    )
    right = members.select(
        "key", "node", "label", F.lit(False).alias("is_left"), every(of_left).alias("i"), deal(of_right).alias("j")
    )
    rows = left.union(right).join(sets, "node")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = (frame[frame["is_left"] == side].reset_index(drop=True) for side in (True, False))
        none = pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        if not len(a) or not len(b):
            return none
        ms, ns = (np.stack([np.frombuffer(x, np.uint16) for x in f["signature"]]) for f in (a, b))
        least = (percent / 100 - MARGIN) * ms.shape[1]
        maybe = np.stack([(ns == m).sum(axis=1) >= least for m in ms])
        maybe &= a["label"].to_numpy()[:, None] != b["label"].to_numpy()[None]
        rows, columns = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        if not len(rows):
            return none
        xs = [np.frombuffer(a["shingles"][i], np.uint64) for i in rows]
        ys = [np.frombuffer(b["shingles"][i], np.uint64) for i in columns]
        same = _intersections(xs, ys)
        total = np.array([len(x) for x in xs])[:, None] + np.array([len(y) for y in ys])[None]
        linked = maybe[np.ix_(rows, columns)] & (100 * same >= percent * (total - same))
        i, j = np.nonzero(linked)
        if not len(i):
            return none
        nodes, roots = least_members(a["node"].to_numpy()[rows[i]], b["node"].to_numpy()[columns[j]])
        return pd.DataFrame({"u": nodes, "v": roots})

    return rows.groupBy("key", "i", "j").applyInPandas(compare, "u long, v long").where("u <> v")


def _intersections(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``xs`` (rows) and ``ys`` (columns)."""
    shared = np.intersect1d(np.concatenate(xs), np.concatenate(ys))

    def places(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(sets)
        at = np.searchsorted(shared, flat)
        there = shared[np.minimum(at, len(shared) - 1)] == flat
        return np.repeat(np.arange(len(sets)), [len(s) for s in sets])[there], at[there]

    out = np.zeros((len(xs), len(ys)), np.int64)
    if not len(shared):
        return out
    (xr, xc), (yr, yc) = places(xs), places(ys)
    for start in range(0, len(shared), _COLUMNS):
        width = min(_COLUMNS, len(shared) - start)
        part = []
        for count, r, c in ((len(xs), xr, xc), (len(ys), yr, yc)):
            mine = (c >= start) & (c < start + width)
            dense = np.zeros((count, width), np.float32)
            dense[r[mine], c[mine] - start] = 1
            part.append(dense)
        out += (part[0] @ part[1].T).astype(np.int64)
    return out


def link_nodes(docs: DataFrame, signed: DataFrame, *, words: int, percent: int) -> DataFrame | None:
    """Rows (node, component) of the nodes that link with another; None if none does."""
    distinct = signed.where("n_shingles > 0").select("doc_id", "digest", "of_set", "node", "signature", "bands").dropDuplicates(["of_set"])
    nodes = staged(distinct, "nodes")
    keyed = nodes.select(F.col("of_set").alias("node"), F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    shared = staged(shared.withColumn("bucket_rows", F.col("n_rows")), "shared")
    buckets = staged(attach(keyed, shared, "key", BANDS * nodes.count()), "buckets")
    size = buckets.count()
    if not size:
        return None
    weights = buckets.groupBy("node").agg(F.sum("bucket_rows").alias("weight"))
    members = staged(buckets.join(weights, "node"), "members")
    wanted = nodes.join(weights, nodes["of_set"] == weights["node"], "left_semi")
    sets = staged(_node_sets(docs, wanted, words), "sets")

    middle = F.max(F.struct("weight", "node"))["node"].alias("hub")
    hubs = staged(members.groupBy("key").agg(F.count("*").alias("n_rows"), middle), "hubs")
    pairs = staged(attach(members, hubs, "key", size).where("node <> hub").select(*_pairs("node", "hub")).distinct(), "pairs")
    with arrow_rows(docs.sparkSession, _PAIR_ROWS):
        verified = staged(_verified(pairs, sets, percent), "verified")
    labels = staged(components(verified), "labels")

    found = members.join(labels, "node", "left").select("key", "node", "weight", F.coalesce("component", "node").alias("label"))
    marked = staged(found, "marked")
    top = F.max(F.struct("weight", "node", "label"))["label"].alias("hub_label")
    open_ = marked.groupBy("key").agg(F.count("*").alias("n_rows"), F.min("label").alias("low"), F.max("label").alias("high"), top)
    open_ = staged(open_.where("low <> high").select("key", "n_rows", F.col("n_rows").alias("bucket_rows"), "hub_label"), "open")
    left = staged(attach(marked, open_, "key", size), "left")
    small = left.where(F.col("bucket_rows") <= SMALL_BUCKET).select("key", "node", "label")
    other = small.select("key", F.col("node").alias("node2"), F.col("label").alias("label2"))
    near = small.join(other, "key").where("node > node2 AND label <> label2").select(*_pairs("node", "node2")).distinct()
    links = _verified(near.join(pairs, ["u", "v"], "left_anti"), sets, percent)
    large = left.where(F.col("bucket_rows") > SMALL_BUCKET)
    others = large.groupBy("key").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("label") != F.col("hub_label")).alias("others")
    )
    others = staged(others.select("*", F.col("n_rows").alias("bucket")), "others")
    large = attach(large.drop("bucket_rows"), others, "key", size).withColumnRenamed("bucket", "n_rows")
    with arrow_rows(docs.sparkSession, _PAIR_ROWS):
        links = staged(links.union(_block_links(large, sets, percent)), "more-links")
    if links.isEmpty():
        return labels
    # What hangs together already is a star, so old links need not be looked at again.
    stars = labels.select(F.col("node").alias("u"), F.col("component").alias("v"))
    return staged(components(links.union(stars)), "labels")


def near_duplicates(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the least id
    of its near-duplicates, itself included), kept (it has that id), group (a number of the
    component, NULL without words), and node and other, the fingerprint of its set.

    Sets link if 100 * intersection >= percent * union.
    """
    signed = _told_apart(staged(_signed(docs, words), "signed"))
    labels = link_nodes(docs, signed, words=words, percent=percent)
    rows = signed.select("doc_id", "n_shingles", F.col("of_set").alias("node"), "other", F.col("node").alias("print"))
    # One row per node; nodes without words stand alone by row.
    nodes = rows.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows"))
    if labels is not None:
        of_node = nodes.join(labels, "node", "left").select("node", "least", "n_rows", F.coalesce("component", "node").alias("group"))
        of_node = staged(of_node, "node-groups")
        groups = staged(of_node.groupBy("group").agg(F.min("least").alias("component_id"), F.count("*").alias("n_rows")), "groups")
        nodes = attach(of_node.select("node", "group", F.col("n_rows").alias("node_rows")), groups, "group", of_node.count())
        nodes = nodes.select("node", "component_id", "group", F.col("node_rows").alias("n_rows"))
    else:
        nodes = nodes.select("node", F.col("least").alias("component_id"), F.col("node").alias("group"), "n_rows")
    nodes = staged(nodes, "node-ids")
    found = attach(rows.where("n_shingles > 0"), nodes, "node", rows.count())
    alone = rows.where("n_shingles = 0").select("*", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("group"))
    both = found.unionByName(alone)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return both.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "group", F.col("print").alias("node"), "other")
