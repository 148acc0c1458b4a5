"""Queries of the incident operators and their SQL, by name."""

from __future__ import annotations

from caseweave.plans import comparison, jobs, measures, merging, source, validation, workloads  # noqa: F401
from caseweave.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
