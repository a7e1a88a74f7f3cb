"""Spark-native normalization and analytics of network-perimeter security logs."""

from rampart.operators.normalize import normalize, verify_integrity
from rampart.specs import ParserSpec, SpecSet, parser_catalog, shipped_specs

__all__ = ["normalize", "verify_integrity", "ParserSpec", "SpecSet", "parser_catalog", "shipped_specs"]
