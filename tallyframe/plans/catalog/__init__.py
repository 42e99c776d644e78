"""All registered queries over the test tables, with their SQL oracles."""

from . import matching, operations, quality, revenue, sampling, sources, staging, streaks  # noqa: F401  (registration side effects)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
