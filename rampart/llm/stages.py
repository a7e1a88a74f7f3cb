"""Stages of the corpus pipeline.

Each takes (spark, docs, sf_dir) and judges all rows of ``docs``, which has at least the
columns of ``documents``; all but the last return these columns.  Models are learned from
the ``labels`` table and from the documents that the stage gets.

A stage that uses Python bounds the rows that the session hands to Python at once, and
leaves it so, as its result is not computed before someone reads it: all stages run in the
same executors, which keep the memory of the largest batches for good.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rampart.llm import language, minhash, mixing, packing, toxicity
from rampart.llm.common import most_arrow_rows, staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A document is rejected as toxic from this score on.
TOXIC = 0.5
# Whole texts are handed to Python so many at once.
TEXT_ROWS = 500


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic score."""
    most_arrow_rows(spark, TEXT_ROWS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(*COLUMNS), model, keep=COLUMNS)
    return scored.where(F.col("toxicity") < TOXIC).select(*COLUMNS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one recognised language: texts without letters and ambiguous ones go.
    Without any known language there is nothing to judge by, and all stay."""
    most_arrow_rows(spark, TEXT_ROWS)
    model = language.train(docs, F.lit(True))
    if not model.langs:
        return docs.select(*COLUMNS)
    found = language.detect(docs.select(*COLUMNS), model, keep=COLUMNS)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & ~F.col("ambiguous")).select(*COLUMNS)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words, similarity 0.8
    or more): the one with the least id; of equal ids one row.  Documents without words
    have no duplicates but rows that are equal in all columns."""
    most_arrow_rows(spark, TEXT_ROWS)
    found = minhash.near_duplicates(docs, words=minhash.WORDS, percent=minhash.PERCENT)
    first = F.col("kept") | F.col("component_id").isNull()
    chosen = staged(found.where(first & (F.col("n_shingles") > 0)).groupBy("group", "doc_id").agg(
        F.min(F.struct("node", "other")).alias("set")
    ).select("doc_id", "set.node", "set.other"), "chosen")
    marked = minhash.with_nodes(docs.select(*COLUMNS), minhash.WORDS)
    same = (
        F.col("_node").eqNullSafe(F.col("node")) & F.col("_other").eqNullSafe(F.col("other"))
    ) & marked["doc_id"].eqNullSafe(chosen["doc_id"])
    full = marked.where("_shingles > 0").join(chosen, same, "left_semi").dropDuplicates(["doc_id", "_node", "_other"])
    empty = marked.where("_shingles = 0").dropDuplicates(list(COLUMNS))
    return full.unionByName(empty).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes its words (rounded)."""
    rows = mixing.mix(docs.select(*COLUMNS))
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + F.lit(0.5))).otherwise(F.lit(0)).cast("int")
    return rows.select(*COLUMNS, F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece of a document in a window of 2048 ids."""
    most_arrow_rows(spark, TEXT_ROWS)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, window=2048, added_tokens=True)
