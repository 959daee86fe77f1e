"""Every operator run over the TPC-H-like tables, with the SQL that must give the same rows."""

from __future__ import annotations

from quarryline.workload import (  # noqa: F401  (importing registers the queries)
    calendar_queries,
    column_queries,
    file_queries,
    plan_queries,
    table_queries,
)
from quarryline.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
