"""The query catalogue: every operator over the given tables, with SQL to compare against."""

from queries import derivations, files, quality, steps  # noqa: F401  registers the queries
from queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
