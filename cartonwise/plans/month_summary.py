"""The month summary and the KPI report as named tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import NoData, Rules, materialized
from cartonwise.functions.dates import shift_month
from cartonwise.operators import kpi, summary
from cartonwise.operators.facts import in_months, rollup
from cartonwise.operators.supplier import line_details, line_totals


def month_summary(lines: DataFrame, contacts: DataFrame, month: dt.date, rules: Rules, published: DataFrame | None = None) -> dict[str, DataFrame]:
    """Whatever adds up comes from one rollup of the chart's months, the published one if it is given; only what counts POs reads
    the lines again."""
    first = shift_month(month, 1 - rules.chart_months)
    base = in_months(published, first, month) if published is not None else materialized(
        rollup(in_months(lines.drop("approved_by"), first, month), "lines", "compliant"))
    details = line_details(in_months(lines, month, month), "month", F.col("origin_country").alias("country"))
    trend = summary.country_trend(base, month, rules, lines)
    yearly = summary.supplier_trend(base, month, rules, lines)
    listed = summary.follow_up(lines, month, rules)
    one_month = lines.sparkSession.range(1).select(F.lit(month).alias("month"))
    return {
        "sources": summary.summary_sources(base, month),
        "country_compliance": summary.country_compliance(in_months(base, month, month)),
        "country_average": summary.country_average(base, month),
        "country_trend": trend,
        "country_order": summary.country_order(trend),
        "line_details": details,
        "line_totals": line_totals(details, "month"),
        "top_suppliers": summary.top_suppliers(lines, month, rules),
        "follow_up": summary.add_emails(listed, contacts),
        "supplier_trend": yearly,
        "yearly_average": summary.yearly_average(yearly, rules),
        "working_days": kpi.month_working_days(one_month, rules),
    }


def kpi_report(lines: DataFrame, month: dt.date, rules: Rules) -> dict[str, DataFrame]:
    """All tables of the KPI report, from one rollup of last year's month to this one. Raises NoData when no table month
    has a line."""
    base = materialized(rollup(in_months(lines, shift_month(month, -12), month), "lines", "active"))
    if kpi.in_any_month(base, kpi.table_months(month)).isEmpty():
        raise NoData(f"no data for the KPI report of {month:%B %Y}")
    tables = kpi.monthly_tables(base, month)
    trend = kpi.supplier_factory_trend(base, month, rules, lines)
    regions = kpi.region_lines(base, month, rules, lines)
    return {
        "monthly_tables": tables,
        "monthly_totals": kpi.monthly_totals(tables),
        "approver_performance": kpi.approver_performance(base, month),
        "lines_per_working_day": kpi.lines_per_working_day(base, month, rules),
        "supplier_factory_trend": trend,
        "region_lines": regions,
        "headline": kpi.headline(trend, regions, month),
        "month_comparison": kpi.month_comparison(base, month, rules),
    }
