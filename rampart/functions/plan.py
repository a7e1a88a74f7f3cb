"""Keeping the optimizer from repeating expensive expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_small_methods(expression: str) -> str:
    """The same value, from a projection that is compiled as many small methods.

    Whole-stage code generation puts all expressions of a projection into one
    method.  Wide ones pass 8000 bytes of bytecode, beyond which the JVM never
    compiles a method and every row runs interpreted, ten times slower.  A
    projection with a lambda is not fused, and its expressions are split up.
    """
    return f"get(transform(array({expression}), x -> x), 0)"


def evaluate_once(df: DataFrame) -> DataFrame:
    """Keep the projection below as it is: computed once, in small methods.

    Catalyst pushes a filter through projections by substituting their expressions.
    Below a chain of projections that each use a column several times, the
    substituted predicate grows with every step (and re-parses the line wherever it
    ends up).  Predicates stop at a projection with a non-deterministic column that
    is in use, while columns not needed above are still pruned through it.
    """
    part = df.select("*", F.expr(in_small_methods("spark_partition_id()")).alias("_part"))
    return part.where("_part >= 0").drop("_part")
