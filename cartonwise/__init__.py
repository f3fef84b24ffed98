"""Packaging-compliance analytics as set-based Spark jobs.

Lines in, metrics out: every function takes and returns DataFrames and covers all suppliers and
months at once. Picking one supplier or one month is a filter on the result.
"""

from cartonwise.config import Rules

__all__ = ["Rules"]
