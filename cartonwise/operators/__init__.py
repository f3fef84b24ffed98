"""Metrics over lines or over their rollup, for all suppliers and months at once."""
