"""Every operator as a query over the given tables, with the SQL that must give the same rows."""

from __future__ import annotations

from . import aggregates, daily, jobs, linkage, rows, upkeep  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
