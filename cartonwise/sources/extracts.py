"""Month extracts: all lines of a month, or one folder per supplier, under the export headers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartonwise.config import PLAIN_FILES, NoData, Rules, many_folders
from cartonwise.functions.regions import supplier_region
from cartonwise.functions.text import file_safe
from cartonwise.operators.facts import in_months
from cartonwise.operators.numbering import sort_columns
from cartonwise.operators.transactions import ORDER
from cartonwise.schema import HEADERS, LINE_COLUMNS, TIME_COLUMNS, VERDICT_HEADER
from cartonwise.sources.exports import canonical_supplier

_HEADER_OF = {name: header for header, name in HEADERS.items()} | {"compliance_status": VERDICT_HEADER}
EXTRACT_COLUMNS = [c for c in LINE_COLUMNS if c in _HEADER_OF]
_RANGES = 4  # for each core, of suppliers that a task writes


def _sheet(c: str):
    """A column as exported: instants become UTC wall-clock time, since sheets know no time zones."""
    value = F.col(c)
    if c in TIME_COLUMNS:
        value = F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz"))
    return value.alias(_HEADER_OF[c])


def month_rows(lines: DataFrame, month: dt.date, supplier: str | None = None) -> DataFrame:
    rows = in_months(lines, month, month)
    return rows if supplier is None else rows.where(F.col("supplier") == supplier)


def month_extract(lines: DataFrame, month: dt.date, supplier: str | None = None) -> DataFrame:
    """The month's lines by handover and update, ties by the other columns. Sorting is by range, so a big month becomes a
    series of ordered files rather than one task's output, and one busy day is split as well."""
    rows = month_rows(lines, month, supplier)
    ordered = rows.orderBy(*sort_columns(ORDER))
    return ordered.select(*(_sheet(c) for c in EXTRACT_COLUMNS))


def write_month_extract(lines: DataFrame, month: dt.date, folder: str) -> None:
    if in_months(lines, month, month).isEmpty():
        raise NoData(f"no data for {month:%b %Y}")
    month_extract(lines, month).write.mode("overwrite").option("header", True).csv(folder)


def by_supplier(lines: DataFrame, month: dt.date, rules: Rules, aliases: DataFrame | None = None) -> DataFrame:
    """The month's lines with the region and file name of their supplier. Lines without a supplier have no file. The
    region is decided per canonical name, from all its countries of the month."""
    named = canonical_supplier(month_rows(lines, month).where(F.col("supplier").isNotNull()), aliases)
    regions = named.groupBy("supplier").agg(supplier_region(F.col("origin_country"), rules).alias("region"))
    keyed = regions.select(F.col("supplier").alias("_supplier"), "region",
                           file_safe(F.col("supplier")).alias("supplier_file"))
    return named.join(keyed, F.col("supplier") == F.col("_supplier")).drop("_supplier")


def selected(lines: DataFrame, month: dt.date, suppliers: DataFrame, rules: Rules) -> DataFrame:
    """by_supplier() for the listed names: repeats count once, names without lines are left out."""
    names = suppliers.select("supplier").distinct()
    return by_supplier(lines.join(names, "supplier", "left_semi"), month, rules)


def write_by_supplier(rows: DataFrame, folder: str) -> None:
    """CSV files under region=/supplier_file=, each supplier's in line order. One range sort serves the folders and
    the order, and spreads a supplier with very many lines over several files. There are several ranges for each core, as a folder
    takes longer to make than its lines to write, and few large tasks would end at different times."""
    if rows.isEmpty():
        raise NoData("no data for these suppliers")
    order = [F.col("region"), F.col("supplier_file"), *sort_columns(ORDER)]
    ranges = _RANGES * rows.sparkSession.sparkContext.defaultParallelism
    ordered = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    sheet = ordered.select("region", "supplier_file", *(_sheet(c) for c in EXTRACT_COLUMNS))
    sheet.write.mode("overwrite").options(**PLAIN_FILES).option("header", True).partitionBy("region", "supplier_file").csv(folder)


def read_by_supplier(spark: SparkSession, folder: str) -> DataFrame:
    """What write_by_supplier() wrote, all cells as text: of names in folders Spark would try every type, and take 007 for a number."""
    kinds = ", ".join(f"`{c}` string" for c in [*(_HEADER_OF[c] for c in EXTRACT_COLUMNS), "region", "supplier_file"])
    with many_folders(spark):
        return spark.read.schema(kinds).option("header", True).csv(folder)
