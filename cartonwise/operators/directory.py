"""The supplier directory, name search and filter lists."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartonwise.config import Rules, materialized
from cartonwise.functions.dates import month_of
from cartonwise.functions.regions import supplier_region
from cartonwise.functions.text import matching_key
from cartonwise.operators.facts import in_months
from cartonwise.operators.filters import contains, named_like, not_blank
from cartonwise.operators.numbering import number_names
from cartonwise.operators.summary import joined_emails

SEARCH_LIMIT = 20


def supplier_countries(lines: DataFrame) -> DataFrame:
    """Distinct countries of each named supplier per month; lines without a date form a month of their own."""
    month = F.date_format(month_of(F.col("handover_date")), "yyyy-MM").alias("month")
    return (lines.where(F.col("supplier").isNotNull())
            .select("supplier", month, F.col("origin_country").alias("country")).distinct())


def supplier_month_regions(countries: DataFrame, rules: Rules) -> DataFrame:
    """Region of each supplier in each dated month it has lines in."""
    dated = countries.where(F.col("month").isNotNull())
    return dated.groupBy(F.col("supplier").alias("name"), "month").agg(
        supplier_region(F.col("country"), rules).alias("region"))


def supplier_directory(countries: DataFrame, contacts: DataFrame, rules: Rules) -> DataFrame:
    """Every supplier with lines or with stored addresses, numbered by name regardless of case. Names match regardless of
    case too; suppliers known only from the contacts have no region."""
    known = countries.groupBy(F.col("supplier").alias("name")).agg(
        supplier_region(F.col("country"), rules).alias("region"))
    known = known.withColumn("_key", matching_key(F.col("name")))
    emails = joined_emails(contacts)
    both = known.join(emails, F.col("_key") == F.col("supplier_name"), "full_outer")
    listed = both.select(F.coalesce("name", "supplier_name").alias("name"), F.coalesce("emails", F.lit("")).alias("emails"),
                         "region", F.lower(F.coalesce("name", "supplier_name")).alias("_by"))
    numbered = number_names(listed, [("_by", True), ("name", True)], "position")
    return numbered.select("position", "name", "emails", "region")


def directory_rows(countries: DataFrame, directory: DataFrame, rules: Rules, text: str = "",
                   month: str | None = None, region: str | None = None) -> DataFrame:
    """The directory filtered by name, and by region: that of the month if one is given, else the overall one."""
    if month is None:
        rows = directory.select("name", F.lit(None).cast("string").alias("month"), "region")
    else:
        rows = supplier_month_regions(countries.where(F.col("month") == month), rules)
    rows = named_like(rows, text, "name")
    return rows.where(F.col("region") == region) if region else rows


def directory_months(countries: DataFrame) -> DataFrame:
    """Months with data, numbered newest first: a few hundred rows, whatever the number of lines."""
    months = countries.select("month").where(F.col("month").isNotNull()).distinct()
    return months.select(F.row_number().over(Window.orderBy(F.col("month").desc())).alias("position"), "month").orderBy("position")


def search_names(lines: DataFrame, month: dt.date, text: str) -> DataFrame:
    """Suppliers and factories of the month whose name contains the text, the first 20 of each by name. A factory
    is listed once per supplier, in rows rather than an array: a factory may have any number of them."""
    text = text.strip()
    picked = in_months(lines, month, month)
    if not text:
        picked = picked.where(F.lit(False))
    pairs = materialized(picked.where(contains("supplier", text) | contains("factory", text)).select("supplier", "factory").distinct())
    suppliers = pairs.where(contains("supplier", text)).select("supplier").distinct().orderBy("supplier").limit(SEARCH_LIMIT)
    pairs = pairs.where(contains("factory", text) & F.col("supplier").isNotNull())
    first = pairs.select("factory").distinct().orderBy("factory").limit(SEARCH_LIMIT)
    factories = pairs.join(first, "factory", "left_semi")
    return suppliers.select(F.lit("supplier").alias("kind"), F.col("supplier").alias("name"), "supplier").unionByName(
        factories.select(F.lit("factory").alias("kind"), F.col("factory").alias("name"), "supplier"))


def filter_options(lines: DataFrame, month: dt.date) -> DataFrame:
    """Distinct countries and approvers of the month, blanks left out, each kind numbered by name: one pass over both
    columns."""
    both = F.array(F.struct(F.lit("country").alias("kind"), F.col("origin_country").alias("value")),
                   F.struct(F.lit("approver").alias("kind"), F.col("approved_by").alias("value")))
    values = in_months(lines, month, month).select(F.inline(both))
    by_name = Window.partitionBy("kind").orderBy("value")
    return values.where(not_blank("value")).distinct().withColumn("position", F.row_number().over(by_name))
