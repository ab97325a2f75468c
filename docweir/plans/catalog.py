"""All registered queries of the engine."""

from __future__ import annotations

from docweir.plans import chunks, gaps, issues, quality, reads, routing, streams, text  # noqa: F401  (modules register what they define)
from docweir.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
