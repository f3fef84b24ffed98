"""Per-supplier metrics of a month, for every supplier and every month in the rows given."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.config import Rules
from cartonwise.functions.dates import month_grid, month_of, shift_month
from cartonwise.functions.numbers import BOARD_UNITS, percent, rate_band, rounded
from cartonwise.functions.text import joined
from cartonwise.operators.facts import facts, in_months, total, up_to
from cartonwise.operators.rates import rates
from cartonwise.schema import STATUSES

DETAIL_COUNTS = ("dest_po_count", "reflected_lines", *STATUSES)


def compliance_rate(rows: DataFrame) -> DataFrame:
    return rates(rows, "supplier", "month").withColumn("rate", rounded(F.col("rate"), 2))


def supplier_range(lines: DataFrame) -> DataFrame:
    return lines.groupBy("supplier").agg(F.min("handover_date").alias("min_date"),
                                         F.max("handover_date").alias("max_date"))


def supplier_kpis(rows: DataFrame) -> DataFrame:
    return facts(rows).groupBy("month", "supplier").agg(
        joined("origin_country").alias("origin_countries"),
        F.count_distinct("factory").alias("factory_count"),
        F.sum("lines").alias("total_lines"),
        F.sum("compliant").alias("compliant_count"),
        F.sum("non_compliant").alias("non_compliant_count"))


def supplier_factories(rows: DataFrame, rules: Rules) -> DataFrame:
    """A supplier's factories with their rate; the band is that of the rounded rate."""
    grouped = facts(rows).groupBy("month", "supplier", "factory").agg(
        joined("origin_country").alias("origin_countries"),
        rounded(percent(F.sum("compliant"), F.sum("lines"))).alias("rate"))
    return grouped.withColumn("band", rate_band(F.col("rate"), rules))


def factory_bands(factories: DataFrame) -> DataFrame:
    return factories.groupBy("month", "supplier", "band").agg(F.count("*").alias("factories"))


def line_details(lines: DataFrame, *keys: str | Column) -> DataFrame:
    """Distinct POs, lines and status counts per group."""
    return facts(lines).groupBy(*keys).agg(
        F.count_distinct("destination_po").alias("dest_po_count"),
        F.sum("lines").alias("reflected_lines"), *total(*STATUSES))


def line_totals(details: DataFrame, *keys: str) -> DataFrame:
    """Sums of the detail rows: a PO in two groups counts twice, as the report's total row does."""
    return details.groupBy(*keys).agg(*total(*DETAIL_COUNTS))


def carton_usage(rows: DataFrame) -> DataFrame:
    """Approved share, approved quantity and corrugated board per factory."""
    # Rounded to tenths of a square metre while still a decimal: exact.
    tenths = F.bround(F.coalesce(F.sum("board"), F.lit(0)).cast("decimal(38,0)"), -5)
    return facts(rows).groupBy("month", "supplier", "factory").agg(
        rounded(percent(F.sum("approved"), F.sum("lines"))).alias("standard_carton_pct"),
        F.coalesce(F.sum("approved_qty"), F.lit(0)).alias("total_carton_qty"),
        (tenths.cast("double") / BOARD_UNITS).alias("corrugated_sqm"))


def densified(grouped: DataFrame, key: str, months: Column, *values: str) -> DataFrame:
    """One row per key and month of its `months` array; values are null where a month has no group. A key's
    groups are at most as many as the months of the chart, so a map per key stays small."""
    entry = F.struct("month", F.struct(*values))
    by_month = grouped.groupBy(key).agg(months.alias("_months"),
                                        F.map_from_entries(F.collect_list(entry)).alias("_values"))
    spread = by_month.select(key, F.explode("_months").alias("month"), "_values")
    found = F.try_element_at("_values", F.col("month"))
    return spread.select(key, "month", *(found[v].alias(v) for v in values))


def first_months(rows: DataFrame) -> DataFrame:
    """The first month with lines of each supplier: two columns of all months."""
    month = month_of(F.col("handover_date")) if "handover_date" in rows.columns else F.col("month")
    dated = rows.select("supplier", month.alias("month")).where(F.col("month").isNotNull())
    return dated.groupBy("supplier").agg(F.min("month").alias("first_month"))


def supplier_series(rows: DataFrame, month: dt.date, rules: Rules, firsts: DataFrame | None = None) -> DataFrame:
    """Chart series up to `month`, from a supplier's own first month: compliance %, approved % and mean density
    of approved lines; 0.0 where a month has none. Measures are read for the chart's months only; `firsts` holds the first
    months if they are known, so that no other month is read."""
    picked = facts(in_months(rows, shift_month(month, 1 - rules.chart_months), month))
    measures = [m for m in ("lines", "compliant", "approved", "density_sum", "density_count") if m in picked.columns]
    grouped = picked.groupBy("supplier", "month").agg(*total(*measures))
    entry = F.struct("month", F.struct(*measures))
    by_month = grouped.groupBy(F.col("supplier").alias("_supplier")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_values"))  # as many entries as the chart has months
    known = first_months(up_to(rows, month)) if firsts is None else firsts
    months = month_grid(F.col("first_month"), month, rules.chart_months)
    spread = known.join(by_month, F.col("supplier").eqNullSafe(F.col("_supplier")), "left").select(
        "supplier", F.explode(months).alias("month"), "_values")
    found = F.try_element_at("_values", F.col("month"))
    grid = spread.select("supplier", "month", *(found[v].alias(v) for v in measures))
    scores = {"compliance": percent(F.col("compliant"), F.col("lines")),
              "approved": percent(F.col("approved"), F.col("lines"))}
    if "density_sum" in measures:
        scores["density"] = F.try_divide(F.col("density_sum").cast("double"), F.col("density_count").cast("double"))
    return grid.select("supplier", "month",
                       *(F.coalesce(rounded(s), F.lit(0.0)).alias(name) for name, s in scores.items()))


def suppliers_for_month(lines: DataFrame, month: dt.date) -> DataFrame:
    return in_months(lines, month, month).select("supplier").distinct()
