"""Lines as facts: keys plus additive measures.

A metric sums measure columns, so it runs unchanged on single lines (each measure 0 or 1) and on the
rollup (each measure a total). Distinct suppliers and factories come from the rollup's keys. Only
distinct POs and the line lists need the lines themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartonwise.functions.dates import month_of, shift_month, within
from cartonwise.functions.numbers import board_area
from cartonwise.schema import COMPLIANT, NON_COMPLIANT, STATUSES

ROLLUP_KEYS = ("month", "origin_country", "supplier", "factory", "approved_by")


def _one(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _status_is(text: str) -> Column:
    return F.col("packaging_status") == text


def _approved(value: Column) -> Column:
    return F.when(_status_is("Approved"), value)


_SIDES = ("carton_length_mm", "carton_width_mm", "carton_height_mm")
# Measure -> (columns it needs, its value for one line).
_MEASURES: dict[str, tuple[set[str], Callable[[], Column]]] = {
    "lines": (set(), lambda: F.lit(1)),
    "compliant": ({"compliance_status"}, lambda: _one(F.col("compliance_status") == COMPLIANT)),
    "non_compliant": ({"compliance_status"}, lambda: _one(F.col("compliance_status") == NON_COMPLIANT)),
    **{name: ({"packaging_status"}, partial(lambda text: _one(_status_is(text)), text))
       for name, text in STATUSES.items()},
    "active": ({"packaging_status"}, lambda: _one(~_status_is("Pending"))),
    "qty": ({"po_qty"}, lambda: F.col("po_qty")),
    "approved_qty": ({"po_qty", "packaging_status"}, lambda: _approved(F.col("po_qty"))),
    "board": ({"po_qty", "packaging_status", *_SIDES},
              lambda: _approved(board_area(F.col("po_qty"), *(F.col(s) for s in _SIDES)))),
    "density_sum": ({"density", "packaging_status"}, lambda: _approved(F.col("density"))),
    "density_count": ({"density", "packaging_status"}, lambda: _one(_status_is("Approved") & F.col("density").isNotNull())),
}


def facts(lines: DataFrame) -> DataFrame:
    """Add month and every measure whose inputs are present; a rollup passes through unchanged."""
    have = set(lines.columns)
    if "lines" in have:
        return lines
    added = {"month": month_of(F.col("handover_date"))}
    added |= {name: value() for name, (needs, value) in _MEASURES.items() if needs <= have}
    return lines.withColumns(added)


def total(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def rollup_measures() -> list[T.StructField]:
    """The measures of a rollup of whole lines, with their types."""
    decimals = {"board": T.DecimalType(30, 0), "density_sum": T.DecimalType(20, 2)}
    return [T.StructField(m, decimals.get(m, T.LongType())) for m in _MEASURES]


def rollup(lines: DataFrame, *measures: str) -> DataFrame:
    """One row per month, country, supplier, factory and approver with the named measures, or all there are. Partial
    sums are made before the shuffle, so a supplier holding a third of the lines sends a few rows per task like any
    other."""
    rows = facts(lines)
    keys = [k for k in ROLLUP_KEYS if k in rows.columns]
    return rows.groupBy(*keys).agg(*total(*(measures or [m for m in _MEASURES if m in rows.columns])))


def _dated(rows: DataFrame, lines: Callable[[str], Column], months: Callable[[str], Column]) -> DataFrame:
    """Filter lines by their handover date and a rollup by its month. A published table is filtered by the month it is
    partitioned by as well, so that other months' files are not opened."""
    if "handover_date" not in rows.columns:
        return rows.where(months("month"))
    if "handover_month" in rows.columns:
        rows = rows.where(months("handover_month"))
    return rows.where(lines("handover_date"))


def in_months(rows: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of the months first..last."""
    return _dated(rows, lambda day: within(F.col(day), first, last),
                  lambda month: F.col(month).between(F.lit(first), F.lit(last)))


def in_any_month(rows: DataFrame, months: list[dt.date]) -> DataFrame:
    """Rows of the listed months."""
    return _dated(rows, lambda day: reduce(or_, (within(F.col(day), m, m) for m in months)),
                  lambda month: F.col(month).isin(*months))


def up_to(rows: DataFrame, month: dt.date) -> DataFrame:
    """Rows of the month and of all before."""
    return _dated(rows, lambda day: F.col(day) < F.lit(shift_month(month, 1)),
                  lambda column: F.col(column) <= F.lit(month))


def beginning(rows: DataFrame) -> DataFrame:
    """One row: first, the earliest day with data. Of a published table or a rollup it is the first day of the earliest
    month, which for the published table is a partition's name: no line is read."""
    column = next(c for c in ("handover_month", "handover_date", "month") if c in rows.columns)
    return rows.agg(F.min(column).alias("first"))


def first_day(rows: DataFrame) -> Column:
    """beginning() as a scalar subquery."""
    return beginning(rows).scalar()
