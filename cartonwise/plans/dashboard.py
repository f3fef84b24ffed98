"""The filtered supplier dashboard and the filtered KPI dashboard."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.config import Rules, materialized
from cartonwise.functions.dates import month_grid, shift_month, working_days
from cartonwise.functions.numbers import percent, percent_change, rate_band, rounded
from cartonwise.functions.regions import country_region, supplier_region
from cartonwise.functions.text import joined
from cartonwise.operators.facts import beginning, facts, in_any_month, in_months, rollup, total
from cartonwise.operators.filters import Filters, in_band, line_filter, not_blank
from cartonwise.operators.kpi import chart_months, per_day
from cartonwise.operators.numbering import number_list
from cartonwise.operators.rates import add_ranks, rates
from cartonwise.schema import STATUSES

PAGE_SIZE = 25


def _supplier_months(rows: DataFrame, f: Filters, rules: Rules) -> DataFrame:
    """One row per supplier from one pass over three months: filtered counts of each month (suffix = months back),
    and, from all its lines of the report month, its region and unfiltered counts."""
    picked = facts(in_months(rows, shift_month(f.month, -2), f.month))
    hit = line_filter(f)

    def at(back: int, value: Column, only: Column | None = None) -> Column:
        condition = F.col("month") == F.lit(shift_month(f.month, -back))
        return F.when(condition if only is None else condition & only, value)

    def count(back: int, column: str) -> Column:
        return F.coalesce(F.sum(at(back, F.col(column), hit)), F.lit(0))

    country = at(0, F.nullif(F.col("origin_country"), F.lit("")), hit)
    return picked.withColumn("_country", country).groupBy("supplier").agg(
        joined("_country").alias("countries"),
        F.count_distinct(at(0, F.col("factory"), hit)).alias("factories"),
        *(count(back, c).alias(f"{c}_{back}") for back in range(3) for c in ("lines", "compliant")),
        *(count(0, s).alias(s) for s in STATUSES),
        supplier_region(at(0, F.col("origin_country")), rules, skip_blank=True).alias("region"),
        F.sum(at(0, F.col("lines"))).alias("all_lines"), F.sum(at(0, F.col("compliant"))).alias("all_compliant"))


def _rated(rows: DataFrame, f: Filters, rules: Rules) -> DataFrame:
    """Supplier rows with raw rates and `shown`: has filtered lines in the month and is in the asked region. The
    region is decided by the report month; earlier months follow by name."""
    found = _supplier_months(rows, f, rules)
    for back in range(3):
        found = found.withColumn(f"rate_{back}", percent(F.col(f"compliant_{back}"), F.col(f"lines_{back}")))
    shown = F.col("lines_0") > 0
    if f.region:
        shown = shown & (F.col("region") == f.region)
    raw = [F.col(f"rate_{back}") for back in range(3)]
    zero = F.lit(0.0)
    rate_sum = F.coalesce(raw[0], zero) + F.coalesce(raw[1], zero) + F.coalesce(raw[2], zero)
    months = sum((r.isNotNull().cast("int") for r in raw), F.lit(0))
    return found.withColumn("shown", shown).withColumn("avg", F.try_divide(rate_sum, months))


def dashboard_suppliers(rows: DataFrame, filters: Filters, rules: Rules) -> DataFrame:
    """The supplier table. Ranks ignore the filters; change and rank are null where there is nothing to compare."""
    f = filters.cleaned()
    # Ranking looks at the supplier rows twice; kept, they are computed in one pass over the lines.
    rated = materialized(_rated(rows, f, rules))
    everyone = rated.where(F.col("all_lines") > 0).select(
        "*", percent(F.col("all_compliant"), F.col("all_lines")).alias("rate"))
    ranked = add_ranks(everyone).where("shown")
    return ranked.select(
        "supplier", "region", F.coalesce("countries", F.lit("")).alias("countries"), "factories",
        F.col("lines_0").alias("lines"), rounded(F.col("rate_0")).alias("compliance"),
        rate_band(F.col("rate_0"), rules).alias("band"), rounded(F.col("avg")).alias("avg_3m"),
        rounded(F.col("rate_0") - F.col("rate_1")).alias("change"), "rank")


def dashboard_cards(rows: DataFrame, filters: Filters, rules: Rules) -> DataFrame:
    """One row of headline figures. Without a region filter the month before counts all its suppliers; with one,
    those of the report month's list."""
    f = filters.cleaned()
    rated = _rated(rows, f, rules)
    shown = F.col("shown")
    before = shown if f.region else F.lit(True)

    def summed(column: str, condition: Column) -> Column:
        return F.sum(F.when(condition, F.col(column)))

    def counted(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    now_rate = percent(summed("compliant_0", shown), summed("lines_0", shown))
    old_rate = percent(summed("compliant_1", before), summed("lines_1", before))
    top_now = counted(shown & (F.col("rate_0") >= rules.top_rate))
    top_old = counted(before & (F.col("rate_1") >= rules.top_rate))
    band = rate_band(F.col("rate_0"), rules)
    low = shown & (F.col("rate_0") < rules.follow_up_rate) & (F.col("avg") < rules.follow_up_rate)
    return rated.agg(
        rounded(now_rate).alias("compliance"), rounded(now_rate - old_rate).alias("compliance_change"),
        top_now.alias("top_count"),
        F.when(counted(before & (F.col("lines_1") > 0)) > 0, top_now - top_old).alias("top_change"),
        counted(low).alias("follow_up_count"),
        *(F.coalesce(summed(s, shown), F.lit(0)).alias(s) for s in STATUSES),
        F.coalesce(summed("lines_0", shown), F.lit(0)).alias("total"),
        counted(shown).alias("all"),
        *(counted(shown & (band == b)).alias(b) for b in ("high", "mid", "low")))


def rate_trend(rows: DataFrame, filters: Filters, rules: Rules) -> DataFrame:
    """Rates per chart month: BD and CN by country, and overall; null without lines. The region filter does not
    apply. No rows when the report month precedes all data; just that month when there is none."""
    f = filters.cleaned()
    picked = in_months(rows, shift_month(f.month, 1 - rules.chart_months), f.month).where(line_filter(f))
    region = country_region(F.col("origin_country"), rules)

    def rate(condition):
        return rounded(percent(F.sum(F.when(condition, F.col("compliant"))), F.sum(F.when(condition, F.col("lines")))))

    monthly = facts(picked).groupBy("month").agg(
        rate(region == "BD").alias("bd"), rate(region == "CN").alias("cn"), rate(F.lit(True)).alias("all"))
    bounds = beginning(rows)
    grid = F.when(F.col("first").isNull(), F.array(F.lit(f.month))).otherwise(
        month_grid(F.col("first"), f.month, rules.chart_months))
    months = bounds.select(F.explode(grid).alias("month"))
    return months.join(monthly, "month", "left")


def country_bars(rows: DataFrame, filters: Filters, rules: Rules) -> DataFrame:
    """Rate per country with its position, best first by the raw rate; the region filter applies to the country."""
    f = filters.cleaned()
    picked = in_months(rows, f.month, f.month).where(line_filter(f)).where(not_blank("origin_country"))
    if f.region:
        picked = picked.where(country_region(F.col("origin_country"), rules) == f.region)
    rated = rates(picked, F.col("origin_country").alias("country"))
    return number_list(rated, ("rate", False), [("country", True)], "position").select(
        "position", "country", rounded(F.col("rate")).alias("rate"))


def supplier_table(suppliers: DataFrame, band: str = "all") -> tuple[DataFrame, list[tuple[str, bool]]]:
    """The band's suppliers and their order on screen, for paging: lowest rounded rate first, then by name."""
    return in_band(suppliers, band), [("compliance", True), ("supplier", True)]


@dataclass(frozen=True)
class KpiDashboard:
    """Tables of the filtered KPI dashboard, all computed from one rollup of the filtered lines."""

    cards: DataFrame
    people: DataFrame
    countries: DataFrame
    approvers: DataFrame


def kpi_lines(rows: DataFrame, filters: Filters, rules: Rules) -> DataFrame:
    """The lines the KPI dashboard counts: month before last year's to the report month."""
    f = filters.cleaned()
    picked = in_months(rows, shift_month(f.month, -12), f.month).where(line_filter(f))
    return picked.where(country_region(F.col("origin_country"), rules) == f.region) if f.region else picked


def kpi_dashboard(rows: DataFrame, filters: Filters, rules: Rules) -> KpiDashboard:
    """All counts come from a rollup by month, country, supplier and factory. Approvers, who would make nearly every line a group
    of its own there, are counted apart, from the lines of two months."""
    f = filters.cleaned()
    picked = kpi_lines(rows, f, rules)
    base = materialized(rollup(picked.drop("approved_by"), "lines", "active"))
    people = kpi_people(rows, base, f, rules)
    return KpiDashboard(kpi_cards(people, base, f, rules), people, kpi_countries(base, f, rules),
                        approver_change(picked, f.month))


def _names_per_month(base: DataFrame, column: str, name: str, rules: Rules) -> DataFrame:
    """month, <name>, bd_<name>, cn_<name>: distinct values of the column, overall and with lines in each region. One row per month
    and value says in which regions it is, so that three counts take one pass."""
    region = country_region(F.col("origin_country"), rules)
    regions = {r.lower(): F.max((region == r).cast("int")).alias(r.lower()) for r in ("BD", "CN")}
    keyed = base.where(F.col(column).isNotNull()).groupBy("month", column).agg(*regions.values())
    return keyed.groupBy("month").agg(F.count("*").alias(name), *(F.sum(r).alias(f"{r}_{name}") for r in regions))


def kpi_people(rows: DataFrame, base: DataFrame, f: Filters, rules: Rules) -> DataFrame:
    """Per chart month: lines, suppliers and factories, overall and per region; 0 without data."""
    region = country_region(F.col("origin_country"), rules)
    shown = in_months(base, shift_month(f.month, 1 - rules.chart_months), f.month)
    lines = shown.groupBy("month").agg(*total("lines"), *(F.sum(F.when(region == r, F.col("lines"))).alias(f"{r.lower()}_lines") for r in ("BD", "CN")))
    out = chart_months(rows, f.month, rules)
    for counts in (lines, _names_per_month(shown, "supplier", "suppliers", rules), _names_per_month(shown, "factory", "factories", rules)):
        out = out.join(counts, "month", "left")
    return out.na.fill(0)


def kpi_cards(people: DataFrame, base: DataFrame, f: Filters, rules: Rules) -> DataFrame:
    """Lines, suppliers and factories with their change on the chart month before (null if the chart has none), and
    non-pending lines per working day in each region, a line without a country counting as CN."""
    measures = ("lines", "suppliers", "factories")

    def at(month: dt.date, column: str) -> Column:
        return F.max(F.when(F.col("month") == F.lit(month), F.col(column)))

    before = shift_month(f.month, -1)
    cards = people.agg(*(at(m, c).alias(f"{c}{suffix}") for c in measures
                         for m, suffix in ((f.month, ""), (before, "_before"))))
    region = country_region(F.col("origin_country"), rules)
    active = in_months(base, f.month, f.month).agg(
        F.struct(*(F.coalesce(F.sum(F.when(region == r, F.col("active"))), F.lit(0)).alias(r)
                   for r in rules.weekends))).scalar()
    days = {r: working_days(F.lit(f.month), off) for r, off in rules.weekends.items()}
    return cards.select(
        "lines", percent_change(F.col("lines"), F.col("lines_before")).alias("lines_change_pct"),
        "suppliers", (F.col("suppliers") - F.col("suppliers_before")).alias("suppliers_change"),
        "factories", (F.col("factories") - F.col("factories_before")).alias("factories_change"),
        *(c for r in rules.weekends for c in (
            active[r].alias(f"{r.lower()}_lines"), days[r].alias(f"{r.lower()}_working_days"),
            per_day(active[r], days[r]).alias(f"{r.lower()}_avg"))))


def kpi_countries(base: DataFrame, f: Filters, rules: Rules) -> DataFrame:
    """Lines per named country in the three table months, null where it had none; whole-percent share of all lines of
    the report month. Countries seen in any month from last year's on are listed."""
    def cell(month: dt.date) -> Column:
        return F.sum(F.when(F.col("month") == F.lit(month), F.col("lines")))

    whole = in_months(base, f.month, f.month).agg(F.sum("lines")).scalar()
    cells = base.where(not_blank("origin_country")).groupBy(F.col("origin_country").alias("country")).agg(
        cell(f.month).alias("lines_m0"), cell(shift_month(f.month, -1)).alias("lines_m1"),
        cell(shift_month(f.month, -12)).alias("lines_m12"))
    share = F.rint(F.try_divide(F.coalesce("lines_m0", F.lit(0)).cast("double"), whole) * 100)
    return cells.withColumn("region", country_region(F.col("country"), rules)).withColumn(
        "share", F.coalesce(share, F.lit(0)).cast("bigint"))


def approver_change(rows: DataFrame, month: dt.date) -> DataFrame:
    """Lines per approver in the month and the one before, for approvers present in either."""
    before = shift_month(month, -1)
    picked = facts(in_any_month(rows, [month, before])).where(not_blank("approved_by"))

    def lines_in(m):
        return F.sum(F.when(F.col("month") == F.lit(m), F.col("lines")).otherwise(0))

    counts = picked.groupBy("approved_by").agg(lines_in(month).alias("now"), lines_in(before).alias("prev"))
    return counts.withColumn("change_pct", percent_change(F.col("now"), F.col("prev")))
