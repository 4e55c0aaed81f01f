"""Registered queries over the star tables, each with its SQL counterpart."""

from monthloom.catalog import explore, files, landed, landing, lines, loading, marts, outcomes, quality, scalars, steps
from monthloom.catalog.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "explore",
    "files",
    "landed",
    "landing",
    "lines",
    "loading",
    "marts",
    "outcomes",
    "quality",
    "scalars",
    "steps",
]
