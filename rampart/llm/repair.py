"""Re-Pair grammar compression of token ids, with random access.

Documents are put in ascending order of id (NULL first, ties by text) and split into
ranges; each range is a shard, written in blocks of about ``BLOCK_TOKENS`` ids.  A block
holds a grammar: frequent pairs of symbols are replaced by new symbols, in at most ``ROUNDS``
rounds and only pairs with ``MIN_COUNT`` uses, until a round replaces under 0.5% of the symbols,
and the rules and the number of ids that each rule expands to are stored.  A document
begins and ends at a symbol, so one document (or a part of it) is decoded alone.

All pairs that are more frequent than the pairs they overlap with are replaced at once
in a round, so a block takes a few passes over its ids.

Rows: every input row is a document of its own, also with a NULL or repeated id.  A NULL
or empty text is its end id alone.  Other columns are not used.  An empty table gives an
empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.llm.common import slices, with_offsets
from rampart.llm.encoding import encoder, gather

BLOCK_TOKENS = 2_000_000
ROUNDS = 12
MIN_COUNT = 8
_HASH_BITS = 20

_BLOCK = (
    "shard int, block int, first_token long, tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "doc_symbols array<long>, first_rule long, rules binary, rule_lengths binary, symbols binary"
)
_BLOCK_TYPES = [
    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
    pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
]


# ------------------------------------------------------------------- the grammar
def compress(
    ids: np.ndarray, last: np.ndarray, first_rule: int, *, rounds: int = ROUNDS, min_count: int = MIN_COUNT
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their ``last`` marks, and rules (pairs; rule k is symbol first_rule + k).

    No pair begins at a symbol marked ``last`` (the end of a document).
    """
    symbols, rules = ids.astype(np.uint32), []
    next_symbol, none = first_rule, 1 << _HASH_BITS
    # Where a frequent pair may begin.  A pair that is not frequent never becomes so: only
    # pairs with a new symbol are added from round to round.
    open_ = np.ones(len(symbols), bool)
    for turn in range(rounds):
        open_[-1:] = False
        at = np.flatnonzero(open_ & ~last)
        left, right = symbols[at], symbols[at + 1]
        mix = left * np.uint32(2654435761 + 2 * turn)
        mix += right * np.uint32(2246822519)
        mix ^= mix >> np.uint32(15)
        mix *= np.uint32(3266489917)
        mix >>= np.uint32(32 - _HASH_BITS)
        bucket = mix.astype(np.int64)
        count = np.bincount(bucket, minlength=none)
        # Frequent buckets by rising count, numbered from 1; 0 stands for all others.
        often = np.flatnonzero(count >= min_count)
        often = often[np.argsort(count[often], kind="stable")]
        place = np.zeros(none, np.int32)
        place[often] = np.arange(1, len(often) + 1, dtype=np.int32)
        which = place[bucket]
        live = np.flatnonzero(which)
        at, which = at[live], which[live]
        # One pair per bucket: others in the bucket wait for another round's hash.
        pair = left[live].astype(np.uint64) << np.uint64(32) | right[live]
        owner = np.zeros(len(often) + 1, np.uint64)
        owner[which] = pair
        owned = owner[which] == pair
        # A pair gives way to a more frequent one that it overlaps with.
        rank = np.zeros(len(symbols) + 2, np.int32)
        rank[at + 1] = np.where(owned, which, 0)
        most = owned & (which >= rank[at]) & (which >= rank[at + 2])
        tied, which = at[most], which[most]
        # Equal neighbours are one pair in a run of a symbol: every other one is taken.
        start = np.flatnonzero(np.diff(tied, prepend=-2) != 1)
        run = np.repeat(start, np.diff(np.append(start, len(tied))))
        taken = (np.arange(len(tied)) - run) % 2 == 0
        chosen, which = tied[taken], which[taken]
        kept = np.bincount(which, minlength=len(often) + 1) >= min_count
        good = kept[which]
        chosen, which = chosen[good], which[good]
        if not len(chosen):
            break
        used = np.flatnonzero(kept)
        name = np.zeros(len(often) + 1, np.uint32)
        name[used] = next_symbol + np.arange(len(used), dtype=np.uint32)
        rules.append(np.stack([owner[used] >> np.uint64(32), owner[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        next_symbol += len(used)
        keep = np.ones(len(symbols), bool)
        keep[chosen + 1] = False
        symbols[chosen] = name[which]
        last[chosen] = last[chosen + 1]
        open_ = np.zeros(len(symbols), bool)
        open_[at] = open_[chosen] = open_[np.maximum(chosen - 1, 0)] = True
        symbols, last, open_ = symbols[keep], last[keep], open_[keep]
        if len(chosen) < len(keep) // 200:
            break
    return symbols, last, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """How many ids each rule expands to.  A rule uses only earlier rules."""
    lengths = np.zeros(len(rules), np.int64)
    open_ = np.arange(len(rules))
    while len(open_):
        parts = rules[open_].astype(np.int64) - first_rule
        size = np.where(parts < 0, 1, lengths[np.maximum(parts, 0)])
        ready = (size > 0).all(axis=1)
        lengths[open_[ready]] = size[ready].sum(axis=1)
        open_ = open_[~ready]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    """The ids that ``symbols`` stand for."""
    # Expansions of all rules, in as many steps as rules are nested.
    flat = np.arange(first_rule, first_rule + len(rules), dtype=np.uint32)
    while True:
        is_rule = flat >= first_rule
        if not is_rule.any():
            break
        out = np.repeat(flat, 1 + is_rule)
        at = (np.cumsum(1 + is_rule) - 2)[is_rule]
        pairs = rules[flat[is_rule] - first_rule]
        out[at], out[at + 1] = pairs[:, 0], pairs[:, 1]
        flat = out
    # Ids below first_rule stand for themselves.
    table = np.append(np.arange(first_rule, dtype=np.uint32), flat)
    size = np.append(np.ones(first_rule, np.int64), lengths)
    start = np.cumsum(size) - size
    symbols = symbols.astype(np.int64)
    return gather(start[symbols], size[symbols], table)


def decode_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive) of what ``symbols`` stand for: only the
    symbols that reach into the range are expanded."""
    rule = np.maximum(symbols.astype(np.int64) - first_rule, 0)
    size = np.where(symbols >= first_rule, lengths[rule] if len(lengths) else 1, 1)
    ends = np.cumsum(size)
    low, high = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
    begin = ends[low] - size[low] if low < len(ends) else 0
    return expand(symbols[low:high], rules, lengths, first_rule)[start - begin : stop - begin]


def _packed(symbols: np.ndarray) -> bytes:
    """Three bytes per symbol as planes (four from 2^24 symbols on); the first byte
    says how many."""
    planes = symbols.astype("<u4").view(np.uint8).reshape(-1, 4)
    width = 3 if not len(symbols) or int(symbols.max()) < 1 << 24 else 4
    return bytes([width]) + planes[:, :width].T.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1)
    full = np.zeros((planes.shape[1], 4), np.uint8)
    full[:, :width] = planes.T
    return full.view("<u4").reshape(-1)


# --------------------------------------------------------------------- the files
def _block(shard: int, number: int, first: int, parts: list[tuple], vocabulary: int) -> tuple:
    doc_ids = [x for part in parts for x in part[0]]
    ids = np.concatenate([part[1] for part in parts])
    sizes = np.concatenate([part[2] for part in parts])
    last = np.zeros(len(ids), bool)
    last[np.cumsum(sizes) - 1] = True
    symbols, last, rules = compress(ids, last, vocabulary)
    per_doc = np.diff(np.flatnonzero(last), prepend=-1)
    return (
        shard, number, first, len(ids), doc_ids, sizes, per_doc, vocabulary, _packed(rules.reshape(-1)),
        _packed(rule_lengths(rules, vocabulary)), _packed(symbols),
    )


def write_repair(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    end_id: int,
    vocabulary: int,
    shards: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    added_tokens: bool = False,
) -> None:
    """Encode ``docs`` (doc_id, text) and write the blocks.

    ``vocabulary``: all ids are below it.  ``shards`` is the number of ranges (default:
    the session's shuffle partitions).  Rows of one id are spread by their text.
    With ``added_tokens`` the strings of special tokens in a text stand for these tokens.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, first = TaskContext.get().partitionId(), 0, 0
        tokens = encoder(tokenizer_path, added_tokens)
        parts: list[tuple] = []
        held = 0

        def block() -> pa.RecordBatch:
            row = _block(shard, number, first, parts, vocabulary)
            names = [x.split()[0] for x in _BLOCK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, _BLOCK_TYPES)], names=names)

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for row, texts in slices(batch, "text"):
                ids, sizes = tokens.encode(texts, end_id)
                parts.append((doc_ids[row : row + len(texts)], ids, sizes))
                held += len(ids)
                if held >= block_tokens:
                    yield block()
                    number, first, held = number + 1, first + held, 0
                    parts.clear()
        if parts:
            yield block()

    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "_spread"]
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("_spread"))
    ranges = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    ranges.select("doc_id", "text").mapInArrow(encode, _BLOCK).write.parquet(path)


def read_repair(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of its ids as little-endian unsigned 32-bit integers), shard, block and the ids."""
    return _documents(spark.read.schema(_BLOCK).parquet(path), keep_ids=True)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """The same without the ids."""
    return _documents(spark.read.schema(_BLOCK).parquet(path), keep_ids=False)


def _documents(blocks: DataFrame, keep_ids: bool) -> DataFrame:
    out_schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, block int, ids binary"
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in out_schema.split(", ")]
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: batch.column(name)[row] for name in batch.schema.names}
                rules = _unpacked(cell["rules"].as_py()).reshape(-1, 2)
                first_rule = cell["first_rule"].as_py()
                lengths = _unpacked(cell["rule_lengths"].as_py()).astype(np.int64)
                ids = expand(_unpacked(cell["symbols"].as_py()), rules, lengths, first_rule).astype("<u4")
                sizes = cell["doc_tokens"].values.to_numpy(zero_copy_only=False)
                stops = np.cumsum(sizes)
                view = memoryview(ids).cast("B")
                pieces = [view[4 * (b - s) : 4 * b] for b, s in zip(stops.tolist(), sizes.tolist())]
                starts = cell["shard_offset"].as_py() + cell["first_token"].as_py() + stops - sizes
                n = len(sizes)
                columns = [
                    cell["doc_ids"].values, starts, sizes, [zlib.crc32(x) for x in pieces],
                    [cell["shard"].as_py()] * n, [cell["block"].as_py()] * n,
                    [bytes(x) for x in pieces] if keep_ids else [None] * n,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    placed = with_offsets(blocks, "shard", "tokens", "shard_offset")
    rows = placed.mapInArrow(decode, out_schema)
    return rows if keep_ids else rows.drop("ids")


def document_ids(block: dict, place: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` of document number ``place`` of one block row (as a
    dict), decoding nothing else."""
    first_rule, rules = block["first_rule"], _unpacked(block["rules"]).reshape(-1, 2)
    symbols, lengths = _unpacked(block["symbols"]), _unpacked(block["rule_lengths"]).astype(np.int64)
    begin = sum(block["doc_symbols"][:place])
    own = symbols[begin : begin + block["doc_symbols"][place]]
    total = block["doc_tokens"][place]
    return decode_range(own, rules, lengths, first_rule, start, total if stop is None else min(stop, total))
