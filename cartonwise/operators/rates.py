"""Compliance rates and what is computed from them: ranks, changes, rolling means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartonwise.functions.dates import month_index
from cartonwise.functions.numbers import percent
from cartonwise.operators.facts import facts, total


def rates(rows: DataFrame, *keys: str | Column) -> DataFrame:
    """Lines, compliant lines and the unrounded rate per group; missing keys form a group of their own."""
    grouped = facts(rows).groupBy(*keys).agg(*total("lines", "compliant"))
    return grouped.withColumn("rate", percent(F.col("compliant"), F.col("lines")))


def add_ranks(rated: DataFrame, *within: str) -> DataFrame:
    """Dense rank by rate (best first), number of named suppliers, and whether the rate is shared, per group.

    A group's window runs over its distinct rates, not over its suppliers; suppliers then look their rate up. There are
    few distinct rates: k different fractions c/n take about k**1.5 lines to make, so even 10 billion lines in a month
    cannot have more than some 5 million."""
    group = Window.partitionBy(*within)
    levels = rated.groupBy(*within, "rate").agg(F.count("*").alias("holders"), F.count("supplier").alias("named"))
    levels = levels.select(
        *(F.col(c).alias(f"_{c}") for c in within), F.col("rate").alias("_rate"),
        F.dense_rank().over(group.orderBy(F.col("rate").desc_nulls_first())).cast("bigint").alias("rank"),
        F.sum("named").over(group).alias("total"), (F.col("holders") > 1).alias("shared"))
    match = F.col("rate") == F.col("_rate")
    for c in within:
        match = match & (F.col(c) == F.col(f"_{c}"))
    joined = rated.join(levels, match, "left")
    # A missing key (a line without a country) has no peers to be ranked among.
    return joined.select(*rated.columns, F.coalesce("rank", F.lit(0)).alias("rank"),
                         F.coalesce("total", F.lit(0)).alias("total"),
                         F.coalesce("shared", F.lit(False)).alias("shared"))


def global_rank(rows: DataFrame) -> DataFrame:
    """Each month's suppliers ranked among all of them."""
    return add_ranks(rates(rows, "month", "supplier"), "month")


def local_rank(rows: DataFrame) -> DataFrame:
    """Each month's suppliers ranked among those shipping from the same country."""
    return add_ranks(rates(rows, "month", "origin_country", "supplier"), "month", "origin_country")


def _calendar_window(*keys: str):
    return Window.partitionBy(*keys).orderBy("_index")


def add_change(rated: DataFrame, *keys: str) -> DataFrame:
    """Rate one calendar month before (null if there were no lines then) and the difference."""
    before = F.max("rate").over(_calendar_window(*keys).rangeBetween(-1, -1))
    return (rated.withColumn("_index", month_index(F.col("month"))).withColumn("prev_rate", before)
            .withColumn("change", F.col("rate") - F.col("prev_rate")).drop("_index"))


def add_rolling_mean(rated: DataFrame, *keys: str, months: int = 3) -> DataFrame:
    """Unweighted mean of the monthly rates available in the last `months` calendar months."""
    mean = F.avg("rate").over(_calendar_window(*keys).rangeBetween(1 - months, 0))
    return rated.withColumn("_index", month_index(F.col("month"))).withColumn("avg_3m", mean).drop("_index")
