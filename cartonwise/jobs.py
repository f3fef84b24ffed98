"""The jobs a user runs: load exports, keep contacts and aliases, write a month's reports and extracts.

    python -m cartonwise.jobs --home DIR load FILE... [--reprocess]
    python -m cartonwise.jobs --home DIR watch FOLDER
    python -m cartonwise.jobs --home DIR recover
    python -m cartonwise.jobs --home DIR import-aliases|import-contacts FILE
    python -m cartonwise.jobs --home DIR set-contact SUPPLIER ADDRESSES
    python -m cartonwise.jobs --home DIR export-contacts FOLDER
    python -m cartonwise.jobs --home DIR supplier-reports|extract [--month 2026-05] [--suppliers NAME...]
    python -m cartonwise.jobs --home DIR summary|kpi|all-supplier-data|retry-reports [--month 2026-05]

DIR holds the line store, what is published of it by month, the contacts, the aliases and, per month, the output; any file
system Spark reaches will do.
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartonwise.config import Rules, materialized, remove, remove_scratch, session_setup
from cartonwise.functions.dates import shift_month
from cartonwise.operators.directory import supplier_countries, supplier_directory
from cartonwise.operators.kpi import latest_month
from cartonwise.plans.month_summary import kpi_report, month_summary
from cartonwise.plans.supplier_report import REPORT_STATUS, report_parts, write_each_report
from cartonwise.schema import ALIASES, CONTACTS
from cartonwise.sources import contacts, extracts
from cartonwise.sources.journal import Journal, read_table
from cartonwise.sources.store import LineStore, Published, clear
from cartonwise.streaming.ingest import arriving_files, export_paths


@dataclass(frozen=True)
class Home:
    spark: SparkSession
    path: str
    rules: Rules = Rules()

    def __post_init__(self) -> None:
        session_setup(self.spark)

    @property
    def store(self) -> LineStore:
        return LineStore(self.spark, f"{self.path}/lines", self.journal)

    @property
    def journal(self) -> Journal:
        return Journal(self.spark, f"{self.path}/journal")

    @property
    def published(self) -> Published:
        return Published(self.spark, f"{self.path}/published")

    def contacts(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/contacts", CONTACTS)

    def aliases(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/aliases", ALIASES)

    def folder(self, month: dt.date, name: str) -> str:
        return f"{self.path}/output/{month:%Y_%B}/{name}"

    def latest_month(self, default: dt.date) -> dt.date:
        return latest_month(self.published.lines.select(F.col("handover_month").alias("handover_date")), default).first().latest_month

    def load(self, paths: list[str], reprocess: bool = False) -> DataFrame:
        """Load exports under the stored aliases and publish the months they change. What an earlier load has stored but not
        published, because it stopped, is published first: a file is Skipped only if its rows are published."""
        self.recover()
        report = materialized(self.store.load(paths, self.aliases(), reprocess))
        self._publish(repair=False)
        return report

    def recover(self) -> list[str]:
        """Publish the files of loads that stopped; returns their names."""
        return self._publish(repair=True)

    def _publish(self, repair: bool) -> list[str]:
        entries = self.journal.unfinished()
        names = set().union(*entries.values())
        if entries:
            self.published.publish_files(self.store, names, repair)
            self.journal.finish(entries)
        return sorted(names)

    def watch(self, folder: str, checkpoint: str | None = None) -> None:
        """Load what has arrived in the folder since the last call."""
        def arrive(files: DataFrame, batch_id: int) -> None:
            if paths := export_paths(files):
                self.load(paths, reprocess=True)

        (arriving_files(self.spark, folder).writeStream.option("checkpointLocation", checkpoint or f"{self.path}/arrivals")
         .trigger(availableNow=True).foreachBatch(arrive).start().awaitTermination())

    def clear(self) -> None:
        remove(self.spark, self.published.path)
        clear(self.spark, self.store.path)
        remove(self.spark, self.journal.path)

    def import_aliases(self, path: str) -> None:
        """Replace the aliases by those of a CSV file with the columns raw_name and canonical_name. They hold for files loaded
        and extracts written from now on."""
        given = self.spark.read.option("header", True).csv(path).select(*(F.trim(c).alias(c) for c in ALIASES.names))
        materialized(given.dropna().dropDuplicates(["raw_name"])).write.mode("overwrite").parquet(f"{self.path}/aliases")

    def import_contacts(self, path: str) -> int:
        """Replace the contacts of the suppliers in the file; returns how many these are."""
        imported = contacts.import_contacts(self.spark.read.option("header", True).csv(path))
        self._replace_contacts(imported)
        return imported.agg(F.count_distinct("supplier_name")).first()[0]

    def set_contact(self, supplier: str, addresses: str) -> None:
        """Replace one supplier's contacts; no address removes them."""
        typed = self.spark.createDataFrame([(supplier, addresses)], "supplier_name string, emails string")
        self._replace_contacts(contacts.typed_contacts(typed))

    def export_contacts(self, folder: str) -> None:
        """Every supplier and its addresses, in the layout that import_contacts reads."""
        listed = supplier_directory(supplier_countries(self.published.lines), self.contacts(), self.rules)
        contacts.contacts_sheet(listed).write.mode("overwrite").option("header", True).csv(folder)

    def supplier_reports(self, month: dt.date, suppliers: DataFrame | None = None) -> DataFrame:
        """One folder per supplier; a run for some suppliers does not touch the full run's output. A supplier whose report fails
        stops no other; returns the status of each report, which is kept for `retry_reports`."""
        name = "Supplier_Reports" if suppliers is None else "Selected_Supplier_Reports"
        return self._report(month, name, suppliers, True)

    def retry_reports(self, month: dt.date) -> DataFrame:
        """Make the reports again that were not written whole by the last full run of the month."""
        status = materialized(read_table(self.spark, self._status(month), REPORT_STATUS))
        done = status.where("status = 'Written'")
        again = self._report(month, "Supplier_Reports", status.where("status <> 'Written'").select("supplier"), False)
        return self._kept_status(month, done.unionByName(again))

    def _report(self, month: dt.date, name: str, suppliers: DataFrame | None, replace_all: bool) -> DataFrame:
        parts = report_parts(self.published.lines, month, self.rules, suppliers, with_transactions=True, firsts=self.published.firsts,
                             published=self.published.rollup)
        status = write_each_report(parts, self.folder(month, name), replace_all)
        return self._kept_status(month, status) if suppliers is None else materialized(status)

    def _kept_status(self, month: dt.date, status: DataFrame) -> DataFrame:
        status = materialized(status)
        status.write.mode("overwrite").parquet(self._status(month))
        return status

    def _status(self, month: dt.date) -> str:
        return self.folder(month, "Supplier_Reports_status")

    def summary(self, month: dt.date) -> list[str]:
        tables = month_summary(self.published.lines, self.contacts(), month, self.rules, self.published.rollup)
        return self._write(tables, month, "Summary_Report")

    def kpi(self, month: dt.date) -> list[str]:
        return self._write(kpi_report(self.published.lines, month, self.rules), month, "KPI_Report")

    def extract(self, month: dt.date, suppliers: DataFrame | None = None) -> str:
        """One file per supplier; with suppliers, of these only and in a folder of their own."""
        folder = self.folder(month, "Supplier_Data" if suppliers is None else "Selected_Supplier_Data")
        lines = self.published.lines
        rows = (extracts.by_supplier(lines, month, self.rules, self.aliases()) if suppliers is None
                else extracts.selected(lines, month, suppliers, self.rules))
        extracts.write_by_supplier(rows, folder)
        return folder

    def all_supplier_data(self, month: dt.date) -> str:
        folder = self.folder(month, "All_Supplier_Data")
        extracts.write_month_extract(self.published.lines, month, folder)
        return folder

    def _replace_contacts(self, given: DataFrame) -> None:
        contacts.save_contacts(contacts.replace_contacts(self.contacts(), given), f"{self.path}/contacts")

    def _write(self, tables: dict[str, DataFrame], month: dt.date, report: str) -> list[str]:
        paths = {name: f"{self.folder(month, report)}/{name}" for name in tables}
        for name, table in tables.items():
            table.write.mode("overwrite").option("ignoreNullFields", False).json(paths[name])
        return list(paths.values())


def _month(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y-%m").date()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cartonwise")
    parser.add_argument("--home", required=True)
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load")
    load.add_argument("files", nargs="+")
    load.add_argument("--reprocess", action="store_true")
    jobs.add_parser("watch").add_argument("folder")
    for name in ("import-aliases", "import-contacts"):
        jobs.add_parser(name).add_argument("file")
    contact = jobs.add_parser("set-contact")
    contact.add_argument("supplier")
    contact.add_argument("addresses")
    jobs.add_parser("export-contacts").add_argument("folder")
    jobs.add_parser("clear")
    jobs.add_parser("recover")
    for name in ("supplier-reports", "summary", "kpi", "extract", "all-supplier-data", "retry-reports"):
        monthly = jobs.add_parser(name)
        monthly.add_argument("--month", type=_month, help="YYYY-MM; the newest month with data if left out")
        if name in ("supplier-reports", "extract"):
            monthly.add_argument("--suppliers", nargs="+")
    return parser


def main(arguments: list[str] | None = None) -> None:
    asked = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName("cartonwise").getOrCreate()
    home = Home(spark, asked.home)
    if asked.job == "load":
        home.load(asked.files, asked.reprocess).show(len(asked.files), truncate=False)
    elif asked.job == "watch":
        home.watch(asked.folder)
    elif asked.job == "import-aliases":
        home.import_aliases(asked.file)
    elif asked.job == "import-contacts":
        print(home.import_contacts(asked.file), "suppliers updated")
    elif asked.job == "set-contact":
        home.set_contact(asked.supplier, asked.addresses)
    elif asked.job == "export-contacts":
        home.export_contacts(asked.folder)
    elif asked.job == "clear":
        home.clear()
    elif asked.job == "recover":
        print(len(home.recover()), "files published again")
    else:
        # Without data, the month of reports is the one before the current month.
        month = asked.month or home.latest_month(shift_month(dt.date.today().replace(day=1), -1))
        options = {}
        if getattr(asked, "suppliers", None):
            options["suppliers"] = spark.createDataFrame([(s,) for s in asked.suppliers], "supplier string")
        result = getattr(home, asked.job.replace("-", "_"))(month, **options)
        if isinstance(result, DataFrame):
            counts = {r.status: r["count"] for r in result.groupBy("status").count().collect()}
            print(counts.pop("Written", 0), "reports in", home.path, *(f"({n} {status.lower()})" for status, n in counts.items()))
        else:
            print(*([result] if isinstance(result, str) else result), sep="\n")
    remove_scratch(spark)


if __name__ == "__main__":
    main()
