"""The library's operators applied to the given tables, each with its SQL twin."""

from workload import cells, checks, entities, files, gaps, marts, rows  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
