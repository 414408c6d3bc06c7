"""Registered queries over the supplied tables, each beside the SQL that must agree with it."""

from riskmart.workload import cleaning, enrichment, evaluation, feeds, learning  # noqa: F401  (register)
from riskmart.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
