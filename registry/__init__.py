"""Every operator bound to the test tables, next to the SQL that must give the same rows."""

from registry import runs, tables, views  # noqa: F401  (importing registers the queries)
from registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
