"""Concatenate and cut: all documents in a row, cut into windows of equal length.

Two passes.  The first encodes each document once and stores its ids with its place
among the ids of its task.  Prefix sums over the totals of the tasks give each task,
and so each document, its global place; the second pass cuts documents where windows
end.  Only the last window of all is not full.

Rows: every row of the input is a document of its own, also with a NULL or repeated id.
A NULL or empty text is its end id alone.  Other columns are not used.  An empty table
gives no pieces.  Documents follow each other as the input's tasks read them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rampart.llm.common import arrow_rows, lean, slices, staged, with_offsets
from rampart.llm.encoding import encoder

_TOKENS = "part int, doc_id long, part_start long, doc_tokens long, ids binary"
# Bounds of a worker's memory beside an executor full of earlier stages: documents at once,
# characters at once, pieces remembered, freed MB kept.
_ROWS = 1_000
_SLICE = 1_000_000
_REMEMBERED = 250_000
_HEAP_MB = 64


def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int, added_tokens: bool = False) -> DataFrame:
    """Per document its ids (little-endian unsigned 32-bit), the task that encoded it and
    the number of ids before it in that task."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        tokens = encoder(tokenizer_path, added_tokens, _REMEMBERED, _HEAP_MB)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, texts in slices(batch, "text", _SLICE):
                ids, sizes = tokens.encode(texts, end_id)
                stops = np.cumsum(sizes)
                blob = ids.astype("<u4").view(np.uint8)
                offsets = np.append(0, stops * 4).astype(np.int32)
                binary = pa.Array.from_buffers(
                    pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(blob)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(texts), part, np.int32)),
                        doc_ids.slice(first, len(texts)),
                        pa.array(before + stops - sizes),
                        pa.array(sizes),
                        binary,
                    ],
                    names=["part", "doc_id", "part_start", "doc_tokens", "ids"],
                )
                before += int(stops[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(encode, keeps=True), _TOKENS)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    end_id: int,
    window: int = 2048,
    keep_ids: bool = True,
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: the part of a document that lies in one window.

    ``start`` counts the document's ids before the piece, ``offset`` its place in the
    window ``sequence_id``.  ``continued`` and ``continues`` are the boundary records:
    the document began in an earlier window, or goes on in the next one.  With
    ``added_tokens`` the strings of special tokens in a text stand for these tokens.
    """
    with arrow_rows(docs.sparkSession, _ROWS):
        tokens = staged(token_rows(docs, tokenizer_path, end_id, added_tokens), "tokens")
    placed = with_offsets(tokens, "part", "doc_tokens", "part_offset")

    # Cut by Spark itself, document by document: no batch of documents and all their pieces is
    # held by a worker, and once more in the executor's buffers.
    first = F.expr(f"place div {window}")
    last = F.expr(f"(place + doc_tokens - 1) div {window}")

    def piece(sequence: Column) -> Column:
        start = F.greatest(sequence * window - F.col("place"), F.lit(0).cast("long"))
        stop = F.least((sequence + 1) * window - F.col("place"), F.col("doc_tokens"))
        ids = F.substring("ids", (4 * start + 1).cast("int"), (4 * (stop - start)).cast("int"))
        named = {"sequence_id": sequence, "start": start, "length": stop - start, "ids": ids}
        return F.struct(*[value.alias(name) for name, value in named.items()])

    documents = placed.select("doc_id", (F.col("part_offset") + F.col("part_start")).alias("place"), "doc_tokens", "ids")
    cut = documents.select("doc_id", "place", "doc_tokens", F.inline(F.transform(F.sequence(first, last), piece)))
    pieces = cut.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        ((F.col("place") + F.col("start")) % window).alias("offset"),
        (F.col("start") > 0).alias("continued"),
        (F.col("start") + F.col("length") < F.col("doc_tokens")).alias("continues"),
        "ids",
    )
    return pieces if keep_ids else pieces.drop("ids")
