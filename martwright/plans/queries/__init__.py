"""Every registered query, by the keys of the operator inventory."""

from __future__ import annotations

from . import dimensions, quality, refresh, report, source, versions
from .registry import QUERIES, inputs_for, run

__all__ = ["QUERIES", "dimensions", "inputs_for", "quality", "refresh", "report", "run", "source", "versions"]
