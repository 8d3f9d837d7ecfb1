"""All registered queries of the audit engine."""

from tidemark.plans import io_queries, relational_queries, scalar_queries  # noqa: F401  (they register themselves)
from tidemark.plans.registry import ORACLES, QUERIES, Tables

__all__ = ["ORACLES", "QUERIES", "Tables"]
