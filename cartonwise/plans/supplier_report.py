"""Every supplier's report in one job.

A report is a set of JSON items, one per fact (a factory, a chart month, a rank ...), in a folder per
region and supplier. Nothing of a supplier is gathered into one row or one task, so a supplier with a
third of all lines, or a long transaction list, is spread like any other data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartonwise.config import PLAIN_FILES, Rules, many_folders, materialized, setting
from cartonwise.functions.numbers import rate_band
from cartonwise.functions.regions import supplier_region
from cartonwise.functions.text import file_safe
from cartonwise.operators import supplier as S
from cartonwise.operators.facts import in_months, rollup
from cartonwise.operators.rates import global_rank, local_rank
from cartonwise.operators.transactions import transactions
from cartonwise.sources.json import to_item


def report_regions(rows: DataFrame, rules: Rules) -> DataFrame:
    """Folder of each supplier: one without any country goes to CN."""
    return rows.groupBy("supplier").agg(supplier_region(F.col("origin_country"), rules, "CN").alias("region"))


def hero(rows: DataFrame, rules: Rules) -> DataFrame:
    """The headline rate, two decimals; its band is that of the rounded figure."""
    rated = S.compliance_rate(rows)
    return rated.withColumn("band", rate_band(F.col("rate"), rules))


def report_sections(lines: DataFrame, base: DataFrame, firsts: DataFrame | None, month: dt.date, rules: Rules,
                    with_transactions: bool = False) -> dict[str, DataFrame]:
    """Section name -> metric of the month with a supplier column. `base` is the month's rollup; distinct POs, series and
    transactions need the lines, `firsts` tells when series begin."""
    factories = S.supplier_factories(base, rules)
    details = S.line_details(in_months(lines, month, month), "month", "supplier", "factory")
    sections = {
        "headline": hero(base, rules),
        "kpis": S.supplier_kpis(base),
        "ranking": global_rank(base).select("month", "supplier", "rank", "total", "shared"),
        "local_ranking": local_rank(base).select("month", "supplier", F.col("origin_country").alias("country"), "rank",
                                                 "total", "shared"),
        "factories": factories,
        "factory_bands": S.factory_bands(factories),
        "line_details": details,
        "line_totals": S.line_totals(details, "month", "supplier"),
        "carton_usage": S.carton_usage(base),
        "series": S.supplier_series(lines, month, rules, firsts).join(
            base.select("supplier").distinct(), "supplier", "left_semi"),
    }
    if with_transactions:
        sections["transactions"] = transactions(lines, month)
    return sections


def report_parts(lines: DataFrame, month: dt.date, rules: Rules, suppliers: DataFrame | None = None, with_transactions: bool = False,
                 firsts: DataFrame | None = None, more: dict[str, DataFrame] | None = None, published: DataFrame | None = None) -> dict[str, DataFrame]:
    """Section name -> region, supplier, section, item (JSON). `suppliers` limits the run to the names listed in it, `more` adds
    sections, tables with a supplier column. A series starts at its supplier's first month, which takes all months' lines to
    know: pass the published first months instead, and the published rollup, so that lines are not rolled up again."""
    base = in_months(published, month, month) if published is not None else materialized(
        rollup(in_months(lines.drop("approved_by"), month, month), "lines", "compliant", "non_compliant", "approved", "approved_qty", "board"))
    regions = report_regions(base, rules)
    if suppliers is not None:
        regions = regions.join(suppliers.select("supplier").distinct(), "supplier", "left_semi")
    regions = materialized(regions)  # every section is joined with it
    # Ranks compare all suppliers, so the selection is applied to the items, not to the lines.
    sections = report_sections(lines, base, firsts, month, rules, with_transactions) | (more or {})
    return {name: df.select("supplier", F.lit(name).alias("section"), to_item(df, skip=("supplier",)).alias("item"))
            .join(regions, "supplier").select("region", "supplier", "section", "item") for name, df in sections.items()}


def report_items(lines: DataFrame, month: dt.date, rules: Rules, suppliers: DataFrame | None = None,
                 with_transactions: bool = False, firsts: DataFrame | None = None) -> DataFrame:
    """region, supplier, section, item of all sections."""
    return reduce(DataFrame.unionByName, report_parts(lines, month, rules, suppliers, with_transactions, firsts).values())


_HASHES = 1 << 31
_FEW = 64  # names of a range that are listed
_AT_ONCE = 8  # attempts that run at the same time


@dataclass(frozen=True)
class _Part:
    """Suppliers of a range of hashes of the name, or by name once these are few."""

    low: int = 0
    high: int = _HASHES
    names: tuple[str, ...] | None = None

    def condition(self) -> Column:
        if self.names is not None:
            return F.col("supplier").isin(*self.names)
        hashed = F.pmod(F.xxhash64("supplier"), F.lit(_HASHES))
        return (hashed >= self.low) & (hashed < self.high)

    def halves(self) -> tuple[_Part, _Part]:
        if self.names is not None:
            middle = len(self.names) // 2
            return replace(self, names=self.names[:middle]), replace(self, names=self.names[middle:])
        middle = (self.low + self.high) // 2
        return replace(self, high=middle), replace(self, low=middle)

    def listed(self, suppliers: DataFrame, count: int) -> _Part:
        """By name, if the range holds few of the `count` suppliers."""
        single = self.high - self.low == 1
        if self.names is not None or not single and count * (self.high - self.low) > _HASHES * _FEW // 2:
            return self
        found = suppliers.where(self.condition()).select("supplier").distinct()
        names = [r.supplier for r in (found if single else found.limit(_FEW + 1)).collect()]
        return replace(self, names=tuple(sorted(names))) if single or len(names) <= _FEW else self


def isolated(suppliers: DataFrame, attempt: Callable[[Column], None], most_failures: int) -> list[tuple[str, Exception]]:
    """attempt(condition) for all suppliers at once; where it fails, for halves of them, down to the suppliers at fault, which
    are returned with their errors. If the one half passes, the fault is in the other, which isn't attempted. The parts at fault
    are halved at the same time, so there are as many steps as for one supplier, however many are at fault. With more than
    most_failures suppliers at fault the error is not theirs, and is raised."""
    count = suppliers.select("supplier").distinct().count()

    def tried(part: _Part) -> Exception | None:
        try:
            attempt(part.condition())
        except Exception as error:
            return error
        return None

    def narrowed(part: _Part, error: Exception | None) -> list[tuple[_Part, Exception | None]]:
        """The halves at fault with their errors, as far as these were attempted; a supplier at fault itself."""
        part = part.listed(suppliers, count)
        if part.names is not None and len(part.names) < 2:
            error = error or (tried(part) if part.names else None)
            return [(part, error)] if part.names and error else []
        low, high = part.halves()
        first = tried(low)
        if first is None:
            return [(high, None)]
        second = tried(high)
        return [(low, first)] + ([(high, second)] if second else [])

    whole = tried(_Part())
    failed, faulty = [], [(_Part(), whole)] if whole else []
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        while faulty:
            step = [found for own in pool.map(lambda f: narrowed(*f), faulty) for found in own]
            faulty = [f for f in step if f[0].names is None or len(f[0].names) > 1 or f[1] is None]
            failed += [(part.names[0], error) for part, error in step if part.names is not None and len(part.names) == 1 and error]
            if len(failed) + len(faulty) > most_failures:
                raise whole
    return failed


def write_reports(items: DataFrame, folder: str) -> DataFrame:
    """Write the items as JSON lines under region=/supplier_file=; returns what was written, as read_reports() does: the driver holds a
    list of all folders for each table of them that is opened, so they are opened once. A supplier with very many items gets several
    files instead of one long task."""
    _write(items, folder, "static")
    return read_reports(items.sparkSession, folder)


def _write(items: DataFrame, folder: str, replaced: str) -> None:
    named = items.withColumn("supplier_file", file_safe(F.col("supplier")))
    spread = named.hint("rebalance", "region", "supplier_file")
    # A folder takes longer to make than its items to write, so parts of few bytes are not joined to one for each core.
    with setting(items.sparkSession, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        (spread.write.mode("overwrite").options(**PLAIN_FILES).option("partitionOverwriteMode", replaced)
         .partitionBy("region", "supplier_file").json(folder))


REPORT_STATUS = T.StructType([T.StructField(n, T.LongType() if n == "items" else T.StringType())
                              for n in ("supplier", "status", "items", "failed_sections", "error")])
_FAULTS = "supplier string, status string, failed_sections string, error string"


def write_each_report(parts: dict[str, DataFrame], folder: str, replace_all: bool = True, most_failures: int | None = None) -> DataFrame:
    """Write the items of all sections like write_reports, but a supplier whose items cannot be made stops no other: of its
    report the sections that fail are left out. Returns supplier, status (Written, Incomplete or Failed), items, failed_sections
    and the first error. Only with replace_all are the reports of other suppliers deleted first. With more suppliers at fault than
    most_failures, by default 20 or one in 50, the error is raised."""
    spark = next(iter(parts.values())).sparkSession
    replaced = "static" if replace_all else "dynamic"
    # The names come from the headline, as every supplier of the month has one.
    names = materialized(parts["headline"].select("supplier").distinct())
    faults: dict[str, dict[str, Exception]] = {}
    try:
        _write(reduce(DataFrame.unionByName, parts.values()), folder, replaced)
    except Exception:
        most = max(20, names.count() // 50) if most_failures is None else most_failures
        good, faults = _without_faults(parts, names, most)
        _write(reduce(DataFrame.unionByName, good.values()), folder, replaced)
    told = [(supplier, "Failed" if len(bad) == len(parts) else "Incomplete", ", ".join(bad), str(next(iter(bad.values()))).split("\n")[0])
            for supplier, bad in faults.items()]
    found = spark.createDataFrame(told, _FAULTS)  # most_failures at most
    written = read_reports(spark, folder).join(names, "supplier", "left_semi").groupBy("supplier").agg(F.count("*").alias("items"))
    return written.join(found, "supplier", "full_outer").select(
        "supplier", F.coalesce("status", F.lit("Written")).alias("status"), F.coalesce("items", F.lit(0)).alias("items"), "failed_sections", "error")


def _without_faults(parts: dict[str, DataFrame], names: DataFrame, most_failures: int) -> tuple[dict[str, DataFrame], dict[str, dict[str, Exception]]]:
    """Each section's items without those of suppliers for which it fails, computed and kept; and the errors by supplier and
    section. Only the sections that fail are attempted for parts of the suppliers."""
    good: dict[str, DataFrame] = {}
    faults: dict[str, dict[str, Exception]] = {}
    for section, items in parts.items():
        try:
            good[section] = materialized(items)
        except Exception:
            failed = isolated(names, lambda part, items=items: items.where(part).write.format("noop").mode("overwrite").save(), most_failures)
            for supplier, error in failed:
                faults.setdefault(supplier, {})[section] = error
                if len(faults) > most_failures:
                    raise error
            good[section] = materialized(items.where(~F.col("supplier").isin([name for name, _ in failed])))
    return good, faults


def read_reports(spark: SparkSession, folder: str) -> DataFrame:
    with many_folders(spark):
        return spark.read.schema("supplier string, section string, item string, region string, supplier_file string").json(folder)
