"""Row numbers and pages over data of any size.

An unpartitioned row_number() would pull every row into one task. `number_rows` range-partitions rows by the order, numbers them
inside their partition, and shifts them by the sizes of the partitions before. `number_list` and `number_names` do the same
within one query, by ranges that are values of the first sort column or lie between sampled ones. `page_of` does not number:
counts per range of values tell where the page lies, and only that range is sorted.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cartonwise.config import materialized


def number_rows(df: DataFrame, order: list[Column], name: str = "sl") -> DataFrame:
    """Add a 1-based sequence number in the given order, which should be total. The partitioned rows are
    written to a table before they are counted: numbers stay valid when a lost executor forces recomputation."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id's low 33 bits count rows inside a partition.
    placed = materialized(placed.withColumn("_part", F.spark_partition_id()).withColumn(
        "_seq", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    sizes = dict(placed.groupBy("_part").count().collect())
    counts = [sizes.get(part, 0) for part in range(max(sizes, default=0) + 1)]
    starts = F.lit(list(accumulate([1, *counts[:-1]])))
    number = F.element_at(starts, F.col("_part") + 1) + F.col("_seq")
    return placed.select(number.cast("bigint").alias(name), *df.columns)


def number_list(df: DataFrame, first: tuple[str, bool], ties: list[tuple[str, bool]], name: str = "sl") -> DataFrame:
    """Add a 1-based sequence number to a list with few distinct values in its first sort column, such as rates: rows are
    numbered within a value and shifted by the counts of the values before it. Nothing runs before the list is read. Both uses
    take the list from the same shuffle and read all its columns, so Spark computes it once."""
    column, ascending = first
    df = df.repartition(column)
    counts = df.groupBy(column).agg(F.sum(1 + _nothing_of(df)).alias("_count"))
    # One row per distinct value: far fewer than the list's lines.
    before = F.sum("_count").over(Window.orderBy(*sort_columns([first])).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col(column).alias("_value"), F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(column).orderBy(*sort_columns(ties)))
    placed = df.withColumn("_place", place).join(starts, F.col(column).eqNullSafe(F.col("_value")))
    return placed.select((F.col("_before") + F.col("_place") + _nothing_of(df)).cast("bigint").alias(name), *df.columns)


def _nothing_of(df: DataFrame) -> Column:
    """0, made of all columns."""
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(1))


def number_names(df: DataFrame, order: list[tuple[str, bool]], name: str = "sl", ranges: int = 200) -> DataFrame:
    """Add a 1-based sequence number to a list with many distinct values in its first sort column, such as names. Rows are
    numbered within ranges between sampled values; the sample and the counts are parts of the same query."""
    column, ascending = order[0]
    sampled = _sampled(df, column, ranges).agg(F.sort_array(F.collect_set("value")).alias("bounds"))  # at most `ranges` values
    ranged = df.withColumn("_bounds", sampled.scalar()).withColumn("_range", _place_among(F.col(column), F.col("_bounds"), ascending))
    return number_list(ranged.drop("_bounds"), ("_range", True), order, name).drop("_range")


def _sampled(df: DataFrame, column: str, values: int) -> DataFrame:
    """(count, value): rows in as many lots, and of each lot the value of a row that a hash picks."""
    lot = F.xxhash64(F.lit("lot"), *(F.col(f"`{c}`") for c in df.columns))
    return df.select(F.col(column).alias("value"), lot.alias("lot")).groupBy(F.pmod("lot", F.lit(values)).alias("part")).agg(
        F.count("*").alias("count"), F.min_by("value", F.struct(F.col("value").isNull(), F.xxhash64("lot"))).alias("value"))


def _place_among(value: Column, bounds: Column, ascending: bool) -> Column:
    """The number of the range that a value lies in, in the order: odd numbers are the bounds themselves, even ones what lies
    between them; nulls come after all going up and before all going down."""
    less = F.coalesce(F.size(F.filter(bounds, lambda b: b < value)), F.lit(0))
    up = less + F.coalesce(F.size(F.filter(bounds, lambda b: b <= value)), F.lit(0))
    highest = 2 * F.coalesce(F.greatest(F.size(bounds), F.lit(0)), F.lit(0)) + 1
    return F.when(value.isNull(), highest if ascending else F.lit(-1)).otherwise(up if ascending else highest - 1 - up).cast("int")


def sort_columns(order: list[tuple[str, bool]]) -> list[Column]:
    """(column, ascending) pairs with nulls placed last going up and first going down."""
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_first() for c, up in order]


def page_of(df: DataFrame, order: list[tuple[str, bool]], page: int, size: int, sorted_at_once: int = 5000,
            values: int = 64) -> tuple[DataFrame, int, int]:
    """(rows, page, total) of a 1-based page; a page outside the list becomes its nearest one.

    A list of up to sorted_at_once rows is sorted. Of a longer one, sampled values of the first sort column cut the list into
    ranges, whose counts tell which of them the page reaches into; these are cut again, by the next column where all rows
    have one value, until so few rows are left. Nothing is written, and no other rows are sorted."""
    found = _sampled(df, order[0][0], values).collect()  # at most `values` rows
    total = sum(r["count"] for r in found)
    last_page = 1 + max(0, total - 1) // size
    page = sorted((1, page, last_page))[1]
    low, high = size * (page - 1), min(size * page, total)
    parts = _stretch(df, order, 0, low, high, total, sorted_at_once, values, [r.value for r in found])
    rows = reduce(DataFrame.unionByName, parts) if parts else df.limit(0)
    return rows.orderBy(*sort_columns(order)), page, total


def _stretch(df: DataFrame, order: list[tuple[str, bool]], column: int, low: int, high: int, total: int, sorted_at_once: int,
             values: int, sample: list | None = None) -> list[DataFrame]:
    """The rows from place low up to high of df, of `total` rows, which agree in the sort columns before `column`."""
    if low >= high:
        return []
    if total <= sorted_at_once or column == len(order):  # rows that agree in all columns are interchangeable
        ordered = df.orderBy(*sort_columns(order[column:])) if column < len(order) else df
        return [(ordered.offset(low) if low else ordered).limit(high - low)]
    name, ascending = order[column]
    if sample is None:
        sample = [r.value for r in _sampled(df, name, values).collect()]
    bounds = list({str(v) if v != v else v: v for v in sample if v is not None}.values())  # in any order; one NaN at most
    kind = df.schema[name].dataType
    place = _place_among(F.col(name), F.lit(bounds).cast(T.ArrayType(kind)) if bounds else F.array().cast(T.ArrayType(kind)), ascending)
    counts = {r.place: r["count"] for r in df.groupBy(place.alias("place")).count().collect()}  # twice the sample at most
    parts, before = [], 0
    for at in sorted(counts):
        start, end = max(low - before, 0), min(high - before, counts[at])
        if start < end:
            # Nulls, and rows that equal a bound, agree in this column.
            agree = at < 0 or at % 2 == 1 and at <= 2 * len(bounds) - 1 or at == 2 * len(bounds) + 1
            parts += _stretch(df.where(place == at), order, column + agree, start, end, counts[at], sorted_at_once, values)
        before += counts[at]
    return parts
