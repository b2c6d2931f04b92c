"""Every registered query."""

from vacantia.plans import (  # noqa: F401
    board_queries, function_queries, refresh_queries, rule_queries, scan_queries, source_queries, stream_queries,
)
from vacantia.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
