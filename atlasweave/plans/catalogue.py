"""All registered queries of the map, gazetteer and graph operators."""

from __future__ import annotations

from . import drawing_queries, gazetteer_queries, map_queries, report_queries  # noqa: F401  (they register)
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
