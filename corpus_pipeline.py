"""A training-corpus pipeline of the operators in ``rampart.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rampart.llm.common import arrow_rows, staged, table
from rampart.llm.stages import TEXT_ROWS, dedup_stage, language_stage, mixing_stage, packing_stage, toxicity_stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("language", language_stage),
    ("near_dedup", dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# Trained models decide in the first two stages and a tokenizer in the last: no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other on ``documents``; each result is written and reread."""
    docs = table(spark, sf_dir, "documents")
    # The stages bound this too; afterwards it is again what it was.
    with arrow_rows(spark, TEXT_ROWS):
        for name, stage in STAGES:
            docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
