"""Every operator as a named query over the order-line tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartonwise import oracle
from cartonwise.config import Rules, materialized, remove, scratch_path, session_setup
from cartonwise.functions.dates import month_grid, month_label, month_of
from cartonwise.functions.numbers import rounded
from cartonwise.functions.regions import country_region, supplier_region
from cartonwise.jobs import Home
from cartonwise.operators import directory, kpi, rates, summary, supplier
from cartonwise.operators.facts import facts, in_months, rollup
from cartonwise.operators.filters import Filters, matching_text
from cartonwise.operators.numbering import number_rows, page_of, sort_columns
from cartonwise.operators.transactions import transactions, transactions_page
from cartonwise.plans import dashboard, month_summary, supplier_report
from cartonwise.sources import contacts, exports, extracts, store, tables
from cartonwise.streaming.ingest import start_ingest

# The report month of every query that takes one, and a supplier found at every scale.
MONTH = dt.date(2001, 10, 1)
SUPPLIER = "Supplier#000000001"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# For metrics without regions.
RULES = Rules()

# Columns each group of metrics reads; the adapter joins only the tables behind them.
PLACE = ("handover_date", "origin_country")
VERDICT = (*PLACE, "supplier", "compliance_status")
PLANT = (*VERDICT, "factory")
PO = (*PLANT, "destination_po")
STATUS = (*PLANT, "packaging_status")


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(session_setup(spark), folder)

    QUERIES[function.__name__] = run
    return run


def rules_for(spark: SparkSession, folder: str) -> Rules:
    """For metrics with regions: the nations that stand in for region BD."""
    return Rules(bd_countries=tables.bd_countries(spark, folder))


def month_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return in_months(tables.read_lines(spark, folder, *columns), MONTH, MONTH)


# --- loading ------------------------------------------------------------------


@query
def derive_lines(spark, folder):
    lines = tables.read_lines(spark, folder, "destination_po", "kimball", "handover_date", "carton_type", "cbm",
                              "density", "compliance_status", "source_file")
    return lines.withColumns({"cbm": F.col("cbm").cast("double"), "density": F.col("density").cast("double")})


def _untidy(cells: DataFrame) -> DataFrame:
    """Export cells as people type them: padded, garbled, in several date forms, by the line's kimball number."""
    kimball = F.col("kimball").cast("bigint")
    day = F.col("handover_date")
    return cells.withColumns({
        "supplier": F.when(kimball % 13 == 0, " nan ").when(kimball % 7 == 0, F.concat(
            F.lit("  "), "supplier", F.lit("\t "))).otherwise(F.col("supplier")),
        "po_qty": F.when(kimball % 11 == 0, "n/a").when(kimball % 5 == 0, F.concat(
            "po_qty", F.lit(".5"))).otherwise(F.col("po_qty")),
        "handover_date": F.when(kimball % 17 == 0, "not a date").when(kimball % 3 == 0, F.concat(
            day, F.lit(" 00:00:00"))).otherwise(day),
        "updated_date": F.when(kimball % 19 == 0, F.concat(
            F.substring("updated_date", 1, 10), F.lit("T23:30:00-07:00"))).otherwise(F.col("updated_date")),
    })


# Columns by which written lines are compared with those that went in.
SHOWN = ("destination_po", "kimball", "supplier", "factory", "po_qty", "handover_date", "packaging_status", "cbm", "density",
         "compliance_status", "source_file")


def _shown(lines: DataFrame, *more: str) -> DataFrame:
    return lines.select(*(F.col(c).cast("double").alias(c) if c in ("cbm", "density") else c for c in (*SHOWN, *more)))


@query
def clean_text(spark, folder):
    cells = exports.select_cells(exports.to_export(tables.read_lines(spark, folder)))
    lines = exports.conform(_untidy(cells))
    return lines.groupBy("supplier").agg(
        F.count("*").alias("lines"), F.count("po_qty").alias("counted"), F.sum("po_qty").alias("qty"),
        F.count("handover_date").alias("dated"), F.min("handover_date").alias("first_day"),
        F.count_if(F.col("compliance_status") == "Compliant").alias("compliant"))


@query
def supplier_alias(spark, folder):
    lines = tables.read_lines(spark, folder, "supplier")
    named = exports.canonical_supplier(lines, tables.read_aliases(spark, folder))
    return named.groupBy("supplier").agg(F.count("*").alias("lines"))


@query
def load_pending_files(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "source_file")
    stored = lines.where(F.col("handover_date") < F.lit(dt.date(2001, 1, 1)))
    return store.pending_files(lines.select("source_file").distinct(), stored)


_TEXT_FILES = 32  # texts that a task writes at a time


def _write_exports(lines: DataFrame, path: str, named: DataFrame) -> list[str]:
    """Lines, dealt by source file, as one packed CSV export per file; returns the paths of the exports in named, the lines'
    source files."""
    with store.open_files(lines.sparkSession, _TEXT_FILES):
        (exports.to_export(lines).write.mode("append").option("header", True).option("compression", "gzip")
         .partitionBy("source_file").csv(path))
    names = named.select("source_file").distinct().collect()  # one row per export file
    return sorted(f"{path}/source_file={r.source_file}" for r in names)


def _load_untidy(spark: SparkSession, folder: str) -> tuple[store.LineStore, DataFrame]:
    """Exports with line breaks and quotes in cells, dates in several forms and cells that cannot be read, one of them
    offered twice; the store they were loaded into, and the load's report."""
    kimball = F.col("Kimball").cast("bigint")
    day = F.to_date("Current Handover Date")
    forms = ("yyyy-MM-dd", "yyyy/M/d", "d-MMM-yyyy", "MMM d, yyyy", "d.M.yyyy", "yyyy-MM-dd HH:mm:ss")
    written = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        written = F.when(kimball % len(forms) == i, F.date_format(day, form)).otherwise(written)
    lines = tables.read_lines(spark, folder, dealt_by="source_file")
    cells = exports.to_export(lines).withColumns({
        "Supplier": F.when(kimball % 13 == 0, "nan").otherwise(F.col("Supplier")),
        "Description": F.concat("Description", F.lit('\nsecond "line", of '), "Kimball"),
        "PO Qty": F.when(kimball % 11 == 0, F.concat("PO Qty", F.lit("d"))).otherwise(F.col("PO Qty")),
        "Current Handover Date": F.when(kimball % 17 == 0, "not a date").otherwise(written)})
    path = scratch_path(spark, "exports")
    with store.open_files(spark, _TEXT_FILES):
        cells.write.option("header", True).option("escape", '"').option("compression", "gzip").partitionBy("source_file").csv(path)
    named = tables.read_lines(spark, folder, "source_file")
    names = sorted(r.source_file for r in named.distinct().collect())  # one row per export file
    paths = [f"{path}/source_file={n}" for n in names]
    target = store.LineStore(spark, scratch_path(spark, "lines"))
    return target, target.load([*paths, f"{path}/./source_file={names[0]}"])


@query
def load_untidy(spark, folder):
    return _load_untidy(spark, folder)[0].read().select(
        "destination_po", "kimball", "colour_code", "supplier", "description", "po_qty", "handover_date", "compliance_status", "source_file")


@query
def load_untidy_report(spark, folder):
    return _load_untidy(spark, folder)[1].select("source_file", "status", "rows", "unreadable_cells")


@query
def load_split_csv(spark, folder):
    """A year's lines in one export, with line breaks and quotes in cells, each file read by several tasks."""
    lines = tables.read_lines(spark, folder).withColumn("source_file", F.date_format("handover_date", "yyyy"))
    cells = exports.to_export(lines).withColumn("Description", F.concat("Description", F.lit('\nsecond "line", of '), "Kimball"))
    arrived = scratch_path(spark, "exports")
    with store.open_files(spark, _TEXT_FILES):
        cells.write.option("header", True).option("escape", '"').partitionBy("source_file").csv(arrived)
    years = sorted(r.source_file for r in lines.select("source_file").distinct().collect())  # a handful
    target = store.LineStore(spark, scratch_path(spark, "lines"), split_bytes=1 << 18)
    sizes = {"spark.sql.files.maxPartitionBytes": str(1 << 18), "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in sizes}
    try:
        for key, value in sizes.items():
            spark.conf.set(key, value)
        target.load([f"{arrived}/source_file={year}" for year in years])
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return target.read().select("destination_po", "kimball", "colour_code", "supplier", "description", "po_qty", "handover_date", "compliance_status",
                                "source_file")


@query
def load_report(spark, folder):
    lines = tables.read_lines(spark, folder, dealt_by="source_file")
    target = store.LineStore(spark, scratch_path(spark, "lines"))
    store.replace_files(lines.where(F.col("handover_date") < F.lit(dt.date(1998, 1, 1))), target.path, by_file=True)
    arrived = scratch_path(spark, "exports")
    paths = _write_exports(lines, arrived, tables.read_lines(spark, folder, "source_file"))
    tables.read_lines(spark, folder, "supplier").groupBy("supplier").count().write.option("header", True).csv(f"{arrived}/not_an_export")
    return target.load([*paths, f"{arrived}/not_an_export"]).select("source_file", "status", "rows")


@query
def replace_by_file(spark, folder):
    lines = tables.read_lines(spark, folder)
    target = store.LineStore(spark, scratch_path(spark, "lines"))
    store.replace_files(lines, target.path)
    again = lines.where(F.col("source_file").isin("2001_09_1-15", "2001_09_16-31"))
    store.replace_files(again.where("packaging_status = 'Approved'"), target.path)
    return _shown(target.read())


@query
def clear_lines(spark, folder):
    target = store.LineStore(spark, scratch_path(spark, "lines"))
    store.replace_files(tables.read_lines(spark, folder), target.path)
    store.clear(spark, target.path)
    kept = tables.read_contacts(spark, folder).agg(F.count("*")).scalar()
    return target.read().agg(F.count("*").alias("lines_left")).withColumn("contacts_left", kept)


@query
def stream_ingest(spark, folder):
    lines = tables.read_lines(spark, folder, dealt_by="source_file")
    arrived, checkpoint = scratch_path(spark, "exports"), scratch_path(spark, "stream")
    target = store.LineStore(spark, scratch_path(spark, "lines"))
    early = F.col("handover_date") < F.lit(dt.date(1999, 1, 1))
    named = tables.read_lines(spark, folder, "handover_date", "source_file")
    for part in (early, ~early):
        _write_exports(lines.where(part), arrived, named.where(part))
        start_ingest(target, arrived, checkpoint, pattern="*.csv.gz", folders=True).awaitTermination()
    return _shown(target.read())


@query
def published_month(spark, folder):
    path = scratch_path(spark, "serving")
    store.publish(tables.read_lines(spark, folder), path)
    return rates.global_rank(in_months(store.read_published(spark, path), MONTH, MONTH)).select(
        "supplier", "lines", "compliant", "rank")


CHANGED = ("2001_10_1-15", "1995_01_1-15")


def _stopped_loads(spark: SparkSession, folder: str) -> Home:
    """Exports loaded in three parts, of which only the first is published: the second load stops when its rows are stored, the
    third while it publishes, with a month's folder and the first months deleted for replacement. Then every export is offered
    again, and at last two of them with fewer lines."""
    lines, named = tables.read_lines(spark, folder, dealt_by="source_file"), tables.read_lines(spark, folder, "packaging_status", "source_file")
    paths = _write_exports(lines, scratch_path(spark, "exports"), named)
    home = Home(spark, scratch_path(spark, "home"))
    third = len(paths) // 3
    home.load(paths[:third])
    home.store.load(paths[third:2 * third])
    home.store.load(paths[2 * third:])
    remove(spark, f"{home.published.path}/lines/handover_month={dt.date(1993, 1, 1)}")
    remove(spark, f"{home.published.path}/first_months")
    home.load(paths)
    changed = F.col("source_file").isin(*CHANGED) & (F.col("packaging_status") == "Approved")
    home.load(_write_exports(lines.where(changed), scratch_path(spark, "exports"), named.where(changed)), reprocess=True)
    return home


@query
def load_resumed(spark, folder):
    return _shown(_stopped_loads(spark, folder).published.lines, "handover_month")


@query
def load_resumed_contents(spark, folder):
    published = _stopped_loads(spark, folder).published
    return published.contents.join(published.firsts, "supplier", "left").groupBy("source_file", "month").agg(
        F.sum("lines").alias("lines"), F.count("*").alias("suppliers"), F.min("first_month").alias("earliest"),
        F.sum((F.col("first_month") == F.col("month")).cast("int")).alias("new_suppliers"))


# --- contacts -----------------------------------------------------------------


@query
def contacts_import(spark, folder):
    sheet = tables.read_contacts(spark, folder).groupBy("supplier_name").agg(
        F.array_join(F.array_sort(F.collect_set("email")), "; ").alias(" E-mail / Email "))
    return contacts.import_contacts(sheet.withColumn("SUPPLIER name", F.upper("supplier_name")).drop("supplier_name"))


@query
def contacts_replace(spark, folder):
    given = tables.table(spark, folder, "supplier").where("s_nationkey < 5").select(
        F.concat(F.lit(" "), F.upper("s_name")).alias("supplier_name"),
        F.when(F.col("s_acctbal") > 0, "new@example.com;new@example.com, ").alias("emails"))
    return contacts.replace_contacts(tables.read_contacts(spark, folder), contacts.typed_contacts(given))


def _directory(spark, folder):
    countries = directory.supplier_countries(tables.read_lines(spark, folder, *PLACE, "supplier"))
    rules = rules_for(spark, folder)
    return countries, directory.supplier_directory(countries, tables.read_contacts(spark, folder), rules), rules


@query
def contacts_export(spark, folder):
    return contacts.contacts_sheet(_directory(spark, folder)[1])


@query
def supplier_directory(spark, folder):
    return _directory(spark, folder)[1]


@query
def directory_filter(spark, folder):
    countries, listed, rules = _directory(spark, folder)
    return directory.directory_rows(countries, listed, rules, "supplier#", f"{MONTH:%Y-%m}", "CN")


@query
def directory_months(spark, folder):
    return directory.directory_months(_directory(spark, folder)[0])


@query
def supplier_countries(spark, folder):
    return directory.supplier_countries(tables.read_lines(spark, folder, *PLACE, "supplier"))


# --- extracts and documents -----------------------------------------------------


@query
def month_extract(spark, folder):
    return extracts.month_extract(tables.read_lines(spark, folder), MONTH)


@query
def extract_by_supplier(spark, folder):
    path = scratch_path(spark, "extract")
    lines = tables.read_lines(spark, folder)
    extracts.write_by_supplier(
        extracts.by_supplier(lines, MONTH, rules_for(spark, folder), tables.read_aliases(spark, folder)), path)
    written = extracts.read_by_supplier(spark, path)
    return written.select("region", "supplier_file", F.col("Supplier").alias("supplier"), F.col("Destination PO").alias("destination_po"),
                          F.col("Kimball").alias("kimball"), F.col("PO Qty").alias("po_qty"),
                          F.col("Current Handover Date").alias("handover_date"), F.col("Compliance Status").alias("compliance_status"))


@query
def extract_selected(spark, folder):
    names = ["Supplier#000000003", SUPPLIER, "Supplier#000000003", "Supplier nobody knows"]
    wanted = spark.createDataFrame([(n,) for n in names], "supplier string")
    rows = extracts.selected(tables.read_lines(spark, folder), MONTH, wanted, rules_for(spark, folder))
    return rows.select("supplier", "region", "supplier_file", "destination_po", "kimball", "po_qty", "handover_date", "compliance_status")


@query
def supplier_json(spark, folder):
    return supplier_report.report_items(tables.read_lines(spark, folder), MONTH, rules_for(spark, folder))


TRANSACTION_FIELDS = ("factory", "destination_po", "kimball", "description", "po_qty", "handover_text", "updated_text", "approved_text", "carton_size",
                      "packaging_status", "compliance_status")


@query
def report_fan_out(spark, folder):
    items = supplier_report.report_items(tables.read_lines(spark, folder), MONTH, rules_for(spark, folder),
                                         with_transactions=True)
    path = scratch_path(spark, "reports")
    written = supplier_report.write_reports(items, path).select("region", "supplier", "section", "item")
    fields = F.from_json("item", ", ".join(f"{f} string" for f in TRANSACTION_FIELDS))
    move = F.concat_ws("|", *(fields[f] for f in TRANSACTION_FIELDS))
    # In one pass, as opening the files takes longer than reading them.
    return written.withColumn("item", F.when(F.col("section") == "transactions", move).otherwise(F.col("item")))


@query
def report_failures(spark, folder):
    """Reports of which a section cannot be made for some suppliers: what became of each, after the others were written."""
    lines = tables.read_lines(spark, folder)
    counted = materialized(in_months(lines, MONTH, MONTH).groupBy("supplier").agg(F.count("*").alias("lines")))  # attempts start from it
    checked = counted.withColumn(
        "lines", F.when(F.col("supplier").endswith("013"), F.raise_error(F.lit("not to be counted"))).otherwise(F.col("lines")))
    parts = supplier_report.report_parts(lines, MONTH, rules_for(spark, folder), more={"checked": checked})
    return supplier_report.write_each_report(parts, scratch_path(spark, "reports")).select("supplier", "status", "items", "failed_sections")


# --- functions ----------------------------------------------------------------


@query
def country_regions(spark, folder):
    rules = rules_for(spark, folder)
    lines = tables.read_lines(spark, folder, "origin_country")
    return lines.groupBy("origin_country").agg(F.count("*").alias("lines")).withColumn(
        "region", country_region(F.col("origin_country"), rules))


@query
def supplier_regions(spark, folder):
    lines = month_lines(spark, folder, *PLACE, "supplier")
    return lines.groupBy("supplier").agg(
        supplier_region(F.col("origin_country"), rules_for(spark, folder)).alias("region"))


@query
def working_days(spark, folder):
    days = tables.read_lines(spark, folder, "handover_date")
    months = days.select(month_of(F.col("handover_date")).alias("month")).distinct()
    return kpi.month_working_days(months, RULES)


@query
def month_spine(spark, folder):
    bounds = tables.read_lines(spark, folder, "handover_date").agg(F.min("handover_date").alias("first"))
    grid = bounds.select(F.posexplode(month_grid(F.col("first"), MONTH, 12)).alias("ordinal", "month"))
    return grid.select("ordinal", "month", month_label(F.col("month")).alias("label"),
                       F.col("month").isin(*kpi.table_months(MONTH)).alias("is_table_month"))


@query
def latest_month(spark, folder):
    return kpi.latest_month(tables.read_lines(spark, folder, "handover_date"))


# --- suppliers ------------------------------------------------------------------


@query
def compliance_rate(spark, folder):
    return supplier.compliance_rate(tables.read_lines(spark, folder, *VERDICT))


@query
def supplier_range(spark, folder):
    return supplier.supplier_range(tables.read_lines(spark, folder, "handover_date", "supplier"))


@query
def supplier_kpis(spark, folder):
    return supplier.supplier_kpis(month_lines(spark, folder, *PLANT)).drop("month")


@query
def supplier_factories(spark, folder):
    return supplier.supplier_factories(month_lines(spark, folder, *PLANT), RULES).drop("month")


@query
def factory_bands(spark, folder):
    factories = supplier.supplier_factories(month_lines(spark, folder, *PLANT), RULES)
    return supplier.factory_bands(factories).drop("month")


def _details(spark, folder):
    lines = month_lines(spark, folder, "handover_date", "supplier", "factory", "destination_po", "packaging_status")
    return supplier.line_details(lines, "supplier", "factory")


@query
def line_details(spark, folder):
    return _details(spark, folder)


@query
def line_totals(spark, folder):
    return supplier.line_totals(_details(spark, folder), "supplier")


@query
def carton_usage(spark, folder):
    lines = month_lines(spark, folder, "handover_date", "supplier", "factory", "po_qty", "packaging_status",
                        "carton_length_mm", "carton_width_mm", "carton_height_mm")
    return supplier.carton_usage(facts(lines)).drop("month")


@query
def supplier_headline(spark, folder):
    return supplier_report.hero(month_lines(spark, folder, *VERDICT), RULES).drop("month")


@query
def supplier_series(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "compliance_status", "packaging_status")
    return supplier.supplier_series(lines, MONTH, RULES)


@query
def density_series(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "compliance_status", "packaging_status",
                              "density")
    return supplier.supplier_series(lines, MONTH, RULES).select("supplier", "month", "density")


@query
def suppliers_for_month(spark, folder):
    return supplier.suppliers_for_month(tables.read_lines(spark, folder, "handover_date", "supplier"), MONTH)


@query
def global_rank(spark, folder):
    ranked = rates.global_rank(month_lines(spark, folder, "handover_date", "supplier", "compliance_status"))
    return ranked.select("supplier", rounded(F.col("rate"), 4).alias("rate"), "rank", "total", "shared")


@query
def global_rank_all_months(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "compliance_status")
    return rates.global_rank(lines).select("month", "supplier", "rank", "total", "shared")


@query
def local_rank(spark, folder):
    ranked = rates.local_rank(month_lines(spark, folder, *VERDICT))
    return ranked.select("supplier", F.col("origin_country").alias("country"), "rank", "total", "shared")


@query
def mom_change(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "compliance_status")
    changed = rates.add_change(rates.rates(lines, "supplier", "month"), "supplier")
    return changed.select("supplier", "month",
                          *(rounded(F.col(c)).alias(c) for c in ("rate", "prev_rate", "change")))


@query
def rolling_3m(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "compliance_status")
    rolled = rates.add_rolling_mean(rates.rates(lines, "supplier", "month"), "supplier")
    return rolled.select("supplier", "month", rounded(F.col("avg_3m")).alias("avg_3m"))


@query
def month_rollup(spark, folder):
    lines = tables.read_lines(spark, folder, *STATUS, "approved_by", "po_qty")
    return rollup(lines).groupBy("month", "origin_country").agg(
        *(F.sum(c).alias(c) for c in ("lines", "compliant", "approved", "pending", "rejected", "escalated", "active",
                                      "qty", "approved_qty")),
        F.count_distinct("supplier").alias("suppliers"), F.count_distinct("approved_by").alias("approvers"))


# --- month summary ----------------------------------------------------------------


@query
def summary_sources(spark, folder):
    return summary.summary_sources(tables.read_lines(spark, folder, "handover_date", "supplier", "factory"), MONTH)


@query
def country_compliance(spark, folder):
    lines = month_lines(spark, folder, *PLACE, "compliance_status")
    return summary.country_compliance(lines).drop("month")


@query
def country_average(spark, folder):
    return summary.country_average(tables.read_lines(spark, folder, *PLACE, "compliance_status"), MONTH)


def _country_details(spark, folder):
    lines = month_lines(spark, folder, *PLACE, "destination_po", "packaging_status")
    return supplier.line_details(lines, F.col("origin_country").alias("country"))


@query
def country_line_details(spark, folder):
    return _country_details(spark, folder)


@query
def country_line_totals(spark, folder):
    return supplier.line_totals(_country_details(spark, folder))


@query
def top_suppliers(spark, folder):
    return summary.top_suppliers(tables.read_lines(spark, folder, *PO), MONTH, RULES)


@query
def follow_up(spark, folder):
    return summary.follow_up(tables.read_lines(spark, folder, *PO, "po_qty"), MONTH, RULES)


@query
def follow_up_emails(spark, folder):
    listed = summary.follow_up(tables.read_lines(spark, folder, *PO, "po_qty"), MONTH, RULES)
    return summary.add_emails(listed, tables.read_contacts(spark, folder)).select("supplier", "avg_3month", "emails")


@query
def country_trend(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "compliance_status")
    return summary.country_trend(lines, MONTH, RULES)


@query
def country_order(spark, folder):
    return summary.country_order(country_trend(spark, folder))


@query
def supplier_trend(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "compliance_status")
    return summary.supplier_trend(lines, MONTH, RULES)


@query
def yearly_search(spark, folder):
    return summary.numbered_suppliers(supplier_trend(spark, folder), " 5")


@query
def yearly_cells(spark, folder):
    return summary.yearly_cells(supplier_trend(spark, folder), RULES)


@query
def yearly_average(spark, folder):
    return summary.yearly_average(supplier_trend(spark, folder), RULES)


# --- KPI report ------------------------------------------------------------------


@query
def kpi_monthly(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "supplier", "factory")
    return kpi.monthly_tables(lines, MONTH)


@query
def kpi_monthly_totals(spark, folder):
    return kpi.monthly_totals(kpi_monthly(spark, folder))


@query
def approver_performance(spark, folder):
    return kpi.approver_performance(tables.read_lines(spark, folder, "handover_date", "approved_by"), MONTH)


@query
def avg_lines_per_day(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "packaging_status")
    return kpi.lines_per_working_day(lines, MONTH, rules_for(spark, folder))


@query
def supplier_factory_trend(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "supplier", "factory")
    return kpi.supplier_factory_trend(lines, MONTH, rules_for(spark, folder))


@query
def region_lines(spark, folder):
    return kpi.region_lines(tables.read_lines(spark, folder, *PLACE), MONTH, rules_for(spark, folder))


@query
def kpi_headline(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "supplier", "factory")
    rules = rules_for(spark, folder)
    return kpi.headline(kpi.supplier_factory_trend(lines, MONTH, rules), kpi.region_lines(lines, MONTH, rules), MONTH)


@query
def month_comparison(spark, folder):
    return kpi.month_comparison(tables.read_lines(spark, folder, *PLACE), MONTH, rules_for(spark, folder))


# --- dashboards ------------------------------------------------------------------


@query
def dashboard_suppliers(spark, folder):
    lines = tables.read_lines(spark, folder, *STATUS)
    return dashboard.dashboard_suppliers(lines, Filters(MONTH, factory="brand#1"), rules_for(spark, folder))


@query
def dashboard_region_filter(spark, folder):
    lines = tables.read_lines(spark, folder, *STATUS)
    return dashboard.dashboard_suppliers(lines, Filters(MONTH, region="bd", country="all"), rules_for(spark, folder))


@query
def dashboard_cards(spark, folder):
    return dashboard.dashboard_cards(tables.read_lines(spark, folder, *STATUS), Filters(MONTH),
                                     rules_for(spark, folder))


@query
def dashboard_cards_region(spark, folder):
    return dashboard.dashboard_cards(tables.read_lines(spark, folder, *STATUS), Filters(MONTH, region="CN"),
                                     rules_for(spark, folder))


@query
def band_filter(spark, folder):
    rules = rules_for(spark, folder)
    listed = dashboard.dashboard_suppliers(tables.read_lines(spark, folder, *STATUS), Filters(MONTH), rules)
    rows, order = dashboard.supplier_table(listed, "low")
    return page_of(rows, order, 1, dashboard.PAGE_SIZE)[0].select("supplier", "compliance", "band", "lines")


@query
def rate_trend(spark, folder):
    return dashboard.rate_trend(tables.read_lines(spark, folder, *VERDICT), Filters(MONTH, region="BD"),
                                rules_for(spark, folder))


@query
def country_bars(spark, folder):
    bars = dashboard.country_bars(tables.read_lines(spark, folder, *VERDICT), Filters(MONTH, region="BD"),
                                  rules_for(spark, folder))
    return bars


@query
def kpi_dashboard(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "supplier", "factory", "packaging_status", "approved_by")
    return dashboard.kpi_dashboard(lines, Filters(MONTH), rules_for(spark, folder)).cards


@query
def kpi_people(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "supplier", "factory", "packaging_status", "approved_by")
    return dashboard.kpi_dashboard(lines, Filters(MONTH, approved_by="2-HIGH"), rules_for(spark, folder)).people


@query
def kpi_countries(spark, folder):
    lines = tables.read_lines(spark, folder, *PLACE, "supplier", "factory", "packaging_status", "approved_by")
    request = Filters(MONTH, region="CN", factory="brand#2")
    return dashboard.kpi_dashboard(lines, request, rules_for(spark, folder)).countries


@query
def approver_change(spark, folder):
    return dashboard.approver_change(tables.read_lines(spark, folder, "handover_date", "approved_by"), MONTH)


# --- lists and search --------------------------------------------------------------


@query
def transaction_list(spark, folder):
    return transactions(tables.read_lines(spark, folder), MONTH).select(
        "supplier", "factory", "destination_po", "kimball", "description", "po_qty", "handover_text", "updated_text",
        "approved_text", "carton_size", "packaging_status", "compliance_status")


@query
def transaction_page(spark, folder):
    rows, page, total = transactions_page(tables.read_lines(spark, folder), SUPPLIER, MONTH, "#", 99, 2)
    return rows.select(F.lit(page).cast("bigint").alias("page"), F.lit(total).cast("bigint").alias("total"),
                       "handover_date", "destination_po", "kimball", "factory", "description", "po_qty")


@query
def text_search(spark, folder):
    lines = tables.read_lines(spark, folder, "destination_po", "kimball", "factory", "description")
    return lines.agg(*(F.count_if(F.coalesce(matching_text(text), F.lit(False))).alias(name) for name, text in (
        ("percent", "%"), ("underscore", "_"), ("brand", "bRAND#1"), ("digits", "99"), ("blank", " "))))


@query
def search_names(spark, folder):
    return directory.search_names(tables.read_lines(spark, folder, "handover_date", "supplier", "factory"), MONTH, "#")


@query
def filter_options(spark, folder):
    return directory.filter_options(tables.read_lines(spark, folder, *PLACE, "approved_by"), MONTH)


@query
def numbered_lines(spark, folder):
    lines = tables.read_lines(spark, folder, "handover_date", "supplier", "destination_po", "kimball")
    order = [(c, True) for c in ("handover_date", "supplier", "destination_po", "kimball")]
    return number_rows(lines, sort_columns(order), "position")


def _as_rows(named: dict[str, DataFrame], fields: dict[str, str]) -> DataFrame:
    """The rows of several tables, as JSON objects, by the table's name."""
    parts = [df.select(*(F.col(c).cast("string").alias(c) if c in ("month", "first_month") else c for c in fields[name].split(", ")))
             for name, df in named.items() if name in fields]
    names = [name for name in named if name in fields]
    rows = [part.select(F.lit(name).alias("table"), F.to_json(F.struct(*part.columns), {"ignoreNullFields": "false"}).alias("item"))
            for name, part in zip(names, parts)]
    return reduce(DataFrame.unionByName, rows)


@query
def month_summary_tables(spark, folder):
    return _as_rows(month_report(spark, folder), {name: fields for name, (_, fields) in oracle.SUMMARY_TABLES.items()})


@query
def kpi_report_tables(spark, folder):
    named = month_summary.kpi_report(tables.read_lines(spark, folder), MONTH, rules_for(spark, folder))
    return _as_rows(named, {name: fields for name, (_, fields) in oracle.KPI_TABLES.items()})


def month_report(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The month summary over the tables, by name."""
    session_setup(spark)
    return month_summary.month_summary(tables.read_lines(spark, folder), tables.read_contacts(spark, folder), MONTH,
                                       rules_for(spark, folder))
