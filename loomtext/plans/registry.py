"""All queries over the driver's tables and their SQL, by name."""

from __future__ import annotations

from . import gate_queries, reader_queries, retrieval_queries  # noqa: F401  register their queries
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
