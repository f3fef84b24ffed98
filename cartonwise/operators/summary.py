"""The month summary: sources, countries, top performers, follow-up list, yearly grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import Rules, materialized
from cartonwise.functions.dates import month_grid, shift_month
from cartonwise.functions.numbers import heat_band, mean_of_rounded, percent, rounded
from cartonwise.functions.text import joined, matching_key
from cartonwise.operators.facts import facts, first_day, in_months, total
from cartonwise.operators.filters import named_like
from cartonwise.operators.numbering import number_list, number_names
from cartonwise.operators.rates import rates
from cartonwise.operators.supplier import densified


def summary_sources(rows: DataFrame, month: dt.date) -> DataFrame:
    """Distinct suppliers and factories of the month: one row, zeros without data."""
    return in_months(rows, month, month).agg(F.count_distinct("supplier").alias("total_suppliers"),
                                             F.count_distinct("factory").alias("total_factories"))


def country_compliance(rows: DataFrame) -> DataFrame:
    rated = rates(rows, "month", F.col("origin_country").alias("country"))
    return rated.select("month", "country", rounded(F.col("rate"), 2).alias("rate"))


def country_trend(rows: DataFrame, month: dt.date, rules: Rules, history: DataFrame | None = None) -> DataFrame:
    """Country rates per chart month, null where a country shipped nothing. `history` tells when data begins, if rows
    do not reach back that far."""
    first = shift_month(month, 1 - rules.chart_months)
    monthly = country_compliance(in_months(rows, first, month))
    months = F.any_value(month_grid(first_day(rows if history is None else history), month, rules.chart_months))
    return densified(monthly, "country", months, "rate")


def country_order(trend: DataFrame) -> DataFrame:
    """Countries numbered by the first month they appear in, then by name."""
    first_seen = trend.where(F.col("rate").isNotNull()).groupBy("country").agg(F.min("month").alias("first_month"))
    return number_list(first_seen, ("first_month", True), [("country", True)], "position")


def supplier_trend(rows: DataFrame, month: dt.date, rules: Rules, history: DataFrame | None = None) -> DataFrame:
    """Supplier rates per chart month, null where a supplier had no lines."""
    first = shift_month(month, 1 - rules.chart_months)
    monthly = rates(in_months(rows, first, month), "month", "supplier")
    monthly = monthly.withColumn("rate", rounded(F.col("rate")))
    months = F.any_value(month_grid(first_day(rows if history is None else history), month, rules.chart_months))
    return densified(monthly, "supplier", months, "rate")


def numbered_suppliers(trend: DataFrame, text: str = "") -> DataFrame:
    """Suppliers of the yearly grid numbered by name; those a search leaves keep their numbers."""
    numbered = number_names(trend.select("supplier").distinct(), [("supplier", True)])
    return named_like(numbered, text.strip())


def yearly_cells(trend: DataFrame, rules: Rules) -> DataFrame:
    """The yearly grid with the shading of each month's cell."""
    return trend.withColumn("heat_band", heat_band(F.col("rate"), rules))


def yearly_average(trend: DataFrame, rules: Rules) -> DataFrame:
    """Mean of a supplier's rounded monthly rates, months without lines skipped, and its shading."""
    means = trend.groupBy("supplier").agg(mean_of_rounded(F.col("rate"), 1).alias("mean"))
    return means.select("supplier", rounded(F.col("mean")).alias("mean_rate"),
                        heat_band(F.col("mean"), rules).alias("heat_band"))


def country_average(rows: DataFrame, month: dt.date) -> DataFrame:
    """Unweighted mean of the month's country rates, and its change on the month before over the countries with
    a rate in both."""
    by_country = country_compliance(in_months(rows, shift_month(month, -1), month)).groupBy("country").agg(
        F.max(F.when(F.col("month") == F.lit(month), F.col("rate"))).alias("now"),
        F.max(F.when(F.col("month") != F.lit(month), F.col("rate"))).alias("before"))
    in_both = F.col("now").isNotNull() & F.col("before").isNotNull()
    change = (mean_of_rounded(F.when(in_both, F.col("now")), 2)
              - mean_of_rounded(F.when(in_both, F.col("before")), 2))
    return by_country.agg(rounded(mean_of_rounded(F.col("now"), 2), 2).alias("avg_rate"),
                          rounded(change, 2).alias("like_for_like_change"))


def _profile():
    return (joined("origin_country").alias("origin_countries"),
            F.count_distinct("factory").alias("factory_count"),
            F.count_distinct("destination_po").alias("dest_po_count"),
            F.sum("lines").alias("reflected_lines"))


def top_suppliers(lines: DataFrame, month: dt.date, rules: Rules) -> DataFrame:
    """Suppliers at or above the top rate, best first, then most lines, numbered."""
    grouped = facts(in_months(lines, month, month)).groupBy("supplier").agg(*_profile(), *total("compliant"))
    rated = grouped.withColumn("raw", percent(F.col("compliant"), F.col("reflected_lines")))
    listed = rated.where(F.col("raw") >= rules.top_rate)
    shown = listed.withColumn("rate", rounded(F.col("raw")))
    shown = materialized(shown)  # a short list, used twice; several distinct counts keep Spark from seeing that both are one
    return number_list(shown, ("raw", False), [("reflected_lines", False), ("supplier", True)]).drop("raw", "compliant")


def follow_up(lines: DataFrame, month: dt.date, rules: Rules) -> DataFrame:
    """Suppliers below the follow-up rate both in the month and in the mean of the last three months' rates
    (months without lines left out), worst first, numbered. One pass over the three months."""
    rows = facts(in_months(lines, shift_month(month, -2), month))

    def when_back(months: int, column: str):
        return F.when(F.col("month") == F.lit(shift_month(month, -months)), F.col(column))

    grouped = rows.withColumn("_country", when_back(0, "origin_country")).groupBy("supplier").agg(
        joined("_country").alias("origin_countries"),
        F.count_distinct(when_back(0, "factory")).alias("factory_count"),
        F.count_distinct(when_back(0, "destination_po")).alias("dest_po_count"),
        F.sum(when_back(0, "qty")).alias("qty"),
        F.sum(when_back(0, "lines")).alias("reflected_lines"),
        *(percent(F.sum(when_back(i, "compliant")), F.sum(when_back(i, "lines"))).alias(f"raw_{i}")
          for i in range(3)))
    # Earlier months are matched by name, which a missing name never does.
    for i in (1, 2):
        grouped = grouped.withColumn(f"raw_{i}", F.when(F.col("supplier").isNotNull(), F.col(f"raw_{i}")))
    raws = [F.col(f"raw_{i}") for i in range(3)]
    rates_sum = F.coalesce(raws[0], F.lit(0.0)) + F.coalesce(raws[1], F.lit(0.0)) + F.coalesce(raws[2], F.lit(0.0))
    available = sum((r.isNotNull().cast("int") for r in raws), F.lit(0))
    rated = grouped.withColumn("raw_avg", F.try_divide(rates_sum, available))
    listed = rated.where((F.col("raw_0") < rules.follow_up_rate) & (F.col("raw_avg") < rules.follow_up_rate))
    shown = listed.select(
        "*", rounded(raws[0]).alias("rate"), rounded(raws[1]).alias("prev_1"), rounded(raws[2]).alias("prev_2"),
        rounded(F.col("raw_avg")).alias("avg_3month"))
    numbered = number_list(materialized(shown), ("raw_avg", True), [("raw_0", True), ("supplier", True)])
    return numbered.drop("raw_0", "raw_1", "raw_2", "raw_avg")


def joined_emails(contacts: DataFrame) -> DataFrame:
    """One row per stored supplier name with its addresses in order."""
    return contacts.groupBy("supplier_name").agg(joined("email").alias("emails"))


def add_emails(listed: DataFrame, contacts: DataFrame, column: str = "supplier") -> DataFrame:
    """Attach each supplier's addresses, '' if none are stored. Only the listed suppliers' contacts are joined
    together, so the list's names limit the contact table before it is grouped."""
    keyed = listed.withColumn("_key", matching_key(F.col(column)))
    wanted = contacts.join(keyed.select(F.col("_key").alias("supplier_name")), "supplier_name", "left_semi")
    emails = joined_emails(wanted)
    found = keyed.join(emails, F.col("_key") == F.col("supplier_name"), "left")
    return found.select(*listed.columns, F.coalesce("emails", F.lit("")).alias("emails"))
