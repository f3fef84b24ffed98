"""Predicates shared by the dashboards, the search and the transaction list."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.functions.text import like_contains


@dataclass(frozen=True)
class Filters:
    """A dashboard request. supplier and factory match part-text, ignoring case; the others match exactly."""

    month: dt.date
    region: str | None = None
    country: str | None = None
    supplier: str | None = None
    factory: str | None = None
    approved_by: str | None = None

    def cleaned(self) -> Filters:
        """Blank or "all" means no filter; region codes are upper-case."""
        kept = {f: None if v in (None, "", "all") else v for f, v in vars(self).items()}
        return replace(self, **(kept | {"region": kept["region"] and kept["region"].upper()}))


def contains(column: str, text: str) -> Column:
    return F.col(column).ilike(like_contains(text))


def line_filter(f: Filters) -> Column:
    """The row-level part of a request. Region is not here: it is decided after aggregation."""
    parts = [F.lit(True)]
    parts += [F.col(c) == v for c, v in (("origin_country", f.country), ("approved_by", f.approved_by)) if v]
    parts += [contains(c, v) for c, v in (("supplier", f.supplier), ("factory", f.factory)) if v]
    return F.coalesce(reduce(and_, parts), F.lit(False))


def not_blank(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def matching_text(text: str | None) -> Column:
    """Search in a line's PO, kimball, factory or description; no text matches every line."""
    if not text or not text.strip():
        return F.lit(True)
    hit = [contains(c, text.strip()) for c in ("destination_po", "kimball", "factory", "description")]
    return hit[0] | hit[1] | hit[2] | hit[3]


def in_band(rows: DataFrame, band: str) -> DataFrame:
    return rows if band == "all" else rows.where(F.col("band") == band)


def named_like(rows: DataFrame, text: str, column: str = "supplier") -> DataFrame:
    """Plain part-text match, ignoring case; no text keeps every row."""
    return rows.where(F.lower(column).contains(text.lower())) if text else rows
