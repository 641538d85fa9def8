"""Query plans bound to the test tables, their parameters, and the SQL oracle."""

from kiln.plans.catalog import QUERIES
from kiln.plans.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]
