"""Registered queries (Spark plan + DuckDB oracle SQL) over the driver tables."""

from . import q_bpe, q_dedup, q_io, q_poem, q_text, q_train  # noqa: F401  (registers queries)
from .catalog import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
