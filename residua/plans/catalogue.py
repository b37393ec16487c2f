"""All registered queries."""

from __future__ import annotations

from residua.plans import queries_detection, queries_models, queries_results, queries_tables  # noqa: F401
from residua.plans.registry import QUERIES

FLAGSHIP = "holdout_report"

__all__ = ["FLAGSHIP", "QUERIES"]
