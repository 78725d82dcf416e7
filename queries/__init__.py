"""Registered queries: each a Spark job over the given tables, most with equivalent SQL."""

from queries import check_queries, corrupt_queries, io_queries, profile_queries, synth_queries, variant_queries  # noqa: F401
from queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
