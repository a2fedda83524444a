"""All queries of the library, and the DuckDB SQL of each, by name."""

from __future__ import annotations

from . import catalog_queries, control_queries, document_queries, state_queries
from .base import ORACLES, QUERIES

MODULES = (catalog_queries, document_queries, state_queries, control_queries)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
