"""The KPI report: month tables, approvers, throughput, trends by region, headline, comparison."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import Rules
from cartonwise.functions.dates import calendar_days, month_grid, month_of, shift_month, working_days
from cartonwise.functions.numbers import percent_change, rounded
from cartonwise.functions.regions import country_region
from cartonwise.operators.facts import beginning, facts, in_any_month, in_months, total
from cartonwise.operators.filters import not_blank


def table_months(month: dt.date) -> list[dt.date]:
    """The report month, the one before, and the same month last year."""
    return [month, shift_month(month, -1), shift_month(month, -12)]


def chart_months(rows: DataFrame, month: dt.date, rules: Rules) -> DataFrame:
    """Months of the KPI charts, oldest first; just the report month when it precedes all data."""
    bounds = beginning(rows)
    grid = F.coalesce(month_grid(F.col("first"), month, rules.chart_months), F.array(F.lit(month)))
    grid = F.when(F.size(grid) > 0, grid).otherwise(F.array(F.lit(month)))
    return bounds.select(F.explode(grid).alias("month"))


def _with_region(rows: DataFrame, rules: Rules) -> DataFrame:
    return facts(rows).withColumn("region", country_region(F.col("origin_country"), rules))


def month_working_days(months: DataFrame, rules: Rules) -> DataFrame:
    month = F.col("month")
    return months.select("month", working_days(month, rules.weekends["BD"]).alias("bd_days"),
                         working_days(month, rules.weekends["CN"]).alias("cn_days"),
                         calendar_days(month).alias("calendar_days"))


def monthly_tables(rows: DataFrame, month: dt.date) -> DataFrame:
    """Suppliers, factories and lines per country in each table month that has data."""
    picked = facts(in_any_month(rows, table_months(month)))
    return picked.groupBy("month", F.col("origin_country").alias("country")).agg(
        F.count_distinct("supplier").alias("suppliers"), F.count_distinct("factory").alias("factories"),
        F.sum("lines").alias("reflected_lines"))


def monthly_totals(tables: DataFrame) -> DataFrame:
    """Sums of the country rows: a supplier shipping from two countries counts twice."""
    return tables.groupBy("month").agg(*total("suppliers", "factories", "reflected_lines"))


def _month_sums(month: dt.date, column: str = "lines"):
    return [F.sum(F.when(F.col("month") == F.lit(m), F.col(column)).otherwise(0)).alias(name)
            for name, m in zip(("m0", "m1", "m12"), table_months(month))]


def approver_performance(rows: DataFrame, month: dt.date) -> DataFrame:
    """Approved lines per approver in each table month: 0 where an approver had none, null where the month has no
    lines at all; and the report month's share of the largest figure shown."""
    picked = facts(in_any_month(rows, table_months(month)))
    groups = picked.groupBy("approved_by").agg(*_month_sums(month))  # blank approvers too: they count for the months
    named = not_blank("approved_by")
    over_all = groups.agg(*(F.sum(m).alias(m) for m in ("m0", "m1", "m12")),
                          F.max(F.when(named, F.greatest("m0", "m1", "m12"))).alias("largest"))
    known = over_all.select(F.struct("m0", "m1", "m12", "largest")).scalar()
    cells = groups.where(named).select("approved_by", F.col("m0").alias("_m0"), *(
        F.when(known[m] > 0, F.col(m)).alias(m) for m in ("m0", "m1", "m12")))
    share = rounded(F.try_divide(F.col("_m0").cast("double"), known["largest"]), 4)
    return cells.withColumn("share_of_max", share).drop("_m0")


def lines_per_working_day(rows: DataFrame, month: dt.date, rules: Rules) -> DataFrame:
    """Non-pending lines of each region over its working days, rounded up. Lines without a country or without a
    status count for neither region."""
    picked = facts(in_months(rows, month, month)).where(F.col("origin_country").isNotNull())
    region = country_region(F.col("origin_country"), rules)
    sums = picked.agg(*(F.coalesce(F.sum(F.when(region == r, F.col("active"))), F.lit(0)).alias(r)
                        for r in rules.weekends))
    days = {r: working_days(F.lit(month), off) for r, off in rules.weekends.items()}
    rows_out = F.array(*(F.struct(F.lit(r).alias("region"), F.col(r).alias("lines"), days[r].alias("working_days"))
                         for r in rules.weekends))
    table = sums.select(F.inline(rows_out))
    return table.withColumn("avg", per_day(F.col("lines"), F.col("working_days")))


def per_day(lines, days):
    return F.coalesce(F.ceil(F.try_divide(lines.cast("double"), days.cast("double"))), F.lit(0)).cast("bigint")


def supplier_factory_trend(rows: DataFrame, month: dt.date, rules: Rules,
                           history: DataFrame | None = None) -> DataFrame:
    """Distinct suppliers and factories per chart month: overall, where one in both regions counts once, and per
    region. Reduced to distinct keys first, so that the six counts expand a small set. `history` tells when data begins,
    if rows do not reach back that far."""
    first = shift_month(month, 1 - rules.chart_months)
    keys = _with_region(in_months(rows, first, month), rules).select("month", "region", "supplier", "factory")
    counts = []
    for name in ("supplier", "factory"):
        plural = "suppliers" if name == "supplier" else "factories"
        counts.append(F.count_distinct(name).alias(plural))
        counts += [F.count_distinct(F.when(F.col("region") == r, F.col(name))).alias(f"{r.lower()}_{plural}")
                   for r in ("BD", "CN")]
    monthly = keys.distinct().groupBy("month").agg(*counts)
    return _on_chart(monthly, rows if history is None else history, month, rules)


def region_lines(rows: DataFrame, month: dt.date, rules: Rules,
                 history: DataFrame | None = None) -> DataFrame:
    """Lines per region and chart month."""
    first = shift_month(month, 1 - rules.chart_months)
    picked = _with_region(in_months(rows, first, month), rules)
    monthly = picked.groupBy("month").agg(
        *(F.sum(F.when(F.col("region") == r, F.col("lines")).otherwise(0)).alias(r.lower()) for r in ("BD", "CN")))
    return _on_chart(monthly, rows if history is None else history, month, rules)


def _on_chart(monthly: DataFrame, rows: DataFrame, month: dt.date, rules: Rules) -> DataFrame:
    """Every chart month once, counts 0 where there is no data."""
    return chart_months(rows, month, rules).join(monthly, "month", "left").na.fill(0)


def headline(trend: DataFrame, lines_by_region: DataFrame, month: dt.date) -> DataFrame:
    """Lines, suppliers and factories of the month against the chart month before, with the region split."""
    both = trend.join(lines_by_region, "month").withColumn("lines", F.col("bd") + F.col("cn"))

    def at(m, column):
        return F.max(F.when(F.col("month") == F.lit(m), F.col(column)))

    before = shift_month(month, -1)
    measures = ("lines", "suppliers", "factories")
    row = both.agg(*(at(m, c).alias(f"{c}_{i}") for c in measures for i, m in enumerate((month, before))),
                   at(month, "bd").alias("bd"), at(month, "cn").alias("cn"))
    share = F.coalesce(F.rint(F.try_divide(F.col("bd").cast("double"), F.col("bd") + F.col("cn")) * 100),
                       F.lit(0)).cast("bigint")
    row = row.withColumn("bd_share", share).withColumn(
        "cn_share", F.when(F.col("bd") + F.col("cn") > 0, 100 - F.col("bd_share")).otherwise(0))
    table = row.select("bd_share", "cn_share", F.inline(F.array(*(
        F.struct(F.lit(c).alias("measure"), F.col(f"{c}_0").alias("now"), F.col(f"{c}_1").alias("before"))
        for c in measures))))
    return table.select("measure", "now", "before",
                        percent_change(F.col("now"), F.col("before")).alias("change_pct"), "bd_share", "cn_share")


def month_comparison(rows: DataFrame, month: dt.date, rules: Rules) -> DataFrame:
    """Lines per country in the table months, null where it had none, and its share of the lines of the first
    table month with data, in whole percent."""
    picked = facts(in_any_month(rows, table_months(month)))
    cells = picked.groupBy(F.col("origin_country").alias("country")).agg(*_month_sums(month))
    totals = cells.agg(*(F.sum(m).alias(m) for m in ("m0", "m1", "m12"))).select(F.struct("m0", "m1", "m12")).scalar()

    def of_first_present(value):
        return F.when(totals["m0"] > 0, value("m0")).when(totals["m1"] > 0, value("m1")).otherwise(value("m12"))

    part, whole = of_first_present(F.col), of_first_present(lambda m: totals[m])
    share = F.coalesce(F.rint(F.try_divide(part.cast("double"), whole) * 100), F.lit(0)).cast("bigint")
    return cells.select("country", country_region(F.col("country"), rules).alias("region"),
                        *(F.nullif(F.col(m), F.lit(0)).alias(f"lines_{m}") for m in ("m0", "m1", "m12")),
                        share.alias("share"))


def latest_month(lines: DataFrame, default: dt.date | None = None) -> DataFrame:
    """Newest month with data, else the default; with the bounds of the data."""
    bounds = lines.agg(F.min("handover_date").alias("min_date"), F.max("handover_date").alias("max_date"))
    newest = month_of(F.col("max_date"))
    return bounds.select(F.coalesce(newest, F.lit(default).cast("date")).alias("latest_month"), "min_date", "max_date")
