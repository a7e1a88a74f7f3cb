"""Queries over log lines derived from the benchmark tables, and their oracles."""
