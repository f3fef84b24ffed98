"""The line store: a Parquet table partitioned by source file, replaced file by file."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartonwise.config import materialized, remove, setting
from cartonwise.functions.dates import month_of
from cartonwise.operators.facts import rollup, rollup_measures
from cartonwise.schema import LINES
from cartonwise.sources.journal import Journal, read_table
from cartonwise.sources.exports import SPLIT_BYTES, UNREADABLE, Layout, conform, export_name, layout_of, read_exports

# Files whose first line is read at the same time.
PROBES = 16
_OPEN_FILES = 4  # that a task writes at a time
_FEW_ALIASES = 50_000  # so many names are joined without a shuffle of the lines
_FEW_MONTHS = 3  # of a file, on average: its lines are published from where they are read
_SORTED_BYTES = 32 << 20  # of the store, by a task that sorts them
_LOADED_BYTES = 16 << 20  # of exports, packed ones mostly, by a task that loads them
_NAMED_FILES = 10_000  # files whose names are listed in a filter
CONTENTS = T.StructType([T.StructField("supplier", T.StringType()), T.StructField("month", T.DateType()), T.StructField("lines", T.LongType()),
                         T.StructField("source_file", T.StringType())])
# month comes last, as the table is partitioned by it.
ROLLUP = T.StructType([*(T.StructField(c, T.StringType()) for c in ("origin_country", "supplier", "factory")), *rollup_measures(),
                       T.StructField("month", T.DateType())])
FIRST_MONTHS = T.StructType([T.StructField("supplier", T.StringType()), T.StructField("first_month", T.DateType())])
REPORT = "path string, source_file string, status string, error string"


def replace_files(lines: DataFrame, path: str, by_file: bool = False) -> None:
    """Write lines so that each file in them replaces its earlier rows and no other file changes. A large file is
    split over several tasks instead of being written by one. by_file: each task's lines are of a few files already, so they stay
    with it."""
    spread = lines if by_file else lines.hint("rebalance", "source_file")
    with open_files(lines.sparkSession, _OPEN_FILES):
        (spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_file")
         .option("compression", "zstd").parquet(path))


def open_files(spark: SparkSession, count: int) -> AbstractContextManager[None]:
    """A task writes so many files at a time as its lines come; only if there are more does it sort the others by file first."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(count))


def clear(spark: SparkSession, path: str) -> None:
    """Remove every line; tables kept elsewhere, such as contacts, are untouched."""
    (spark.createDataFrame([], LINES).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("source_file").parquet(path))


def pending_files(offered: DataFrame, stored: DataFrame) -> DataFrame:
    """Offered files (column source_file) that have no stored rows."""
    return offered.join(stored.select("source_file").distinct(), "source_file", "left_anti")


def _small_parts(spark: SparkSession, most: int) -> AbstractContextManager[None]:
    """Tables are read in parts of so many bytes at most, which a task can sort in memory, or which make for tasks that end together."""
    own = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return setting(spark, "spark.sql.files.maxPartitionBytes", str(min(own, most)))


def publish(lines: DataFrame, path: str, by_month: bool = False) -> None:
    """Serving copy partitioned by month, so that a month's metrics read that month only. Within a month's files
    lines are sorted by supplier, which lets a supplier filter skip row groups. The months in `lines` are replaced, others
    stay. by_month: each task's lines are of a few months already, so they stay with it."""
    dated = lines.withColumn("handover_month", month_of(F.col("handover_date")))
    spread = dated if by_month else dated.hint("rebalance", "handover_month")
    (spread.sortWithinPartitions("handover_month", "supplier").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("handover_month").option("compression", "zstd").parquet(path))


def publish_rollup(lines: DataFrame, path: str) -> None:
    """Monthly totals per country, supplier and factory for every metric that adds up. Approvers would make nearly every
    line a group of its own."""
    (rollup(lines.drop("approved_by")).hint("rebalance", "month").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month").option("compression", "zstd").parquet(path))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """A published table. Metrics filter it by handover_month too, without reading other months."""
    return read_table(spark, path, T.StructType([*LINES.fields, T.StructField("handover_month", T.DateType())]))


def content_of(lines: DataFrame) -> DataFrame:
    """What files hold: their lines per supplier and month, far fewer rows than the lines."""
    return lines.groupBy("source_file", "supplier", month_of(F.col("handover_date")).alias("month")).agg(F.count("*").alias("lines"))


@dataclass(frozen=True)
class Published:
    """What the monthly jobs read: lines by month, their rollup, and each supplier's first month.

    `contents` tells what of each file is published. With it the months and suppliers that a file's earlier rows fell into are
    known without reading lines, and so are the files that hold a month."""

    spark: SparkSession
    path: str

    @property
    def lines(self) -> DataFrame:
        return read_published(self.spark, f"{self.path}/lines")

    @property
    def rollup(self) -> DataFrame:
        """Monthly totals per country, supplier and factory, of all measures; of a folder with lines alone these are summed."""
        try:
            return self.spark.read.schema(ROLLUP).parquet(f"{self.path}/rollup")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        totals = rollup(self.lines.drop("handover_month", "approved_by"))
        return totals.select(*(F.col(f.name).cast(f.dataType) for f in ROLLUP.fields))

    @property
    def firsts(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/first_months", FIRST_MONTHS)

    @property
    def contents(self) -> DataFrame:
        return read_table(self.spark, f"{self.path}/contents", CONTENTS).where("lines > 0")

    def publish_files(self, store: LineStore, names: set[str], repair: bool = False) -> None:
        """Publish what the store holds of the named files, which may be nothing any more, in the place of what was published of
        them. Months that neither held are not read or written. Every step can be repeated: the months are built from the
        store, and `contents`, which tells what the earlier rows were, is replaced last. With repair the first months are
        built from all contents, as a stopped run may have lost some."""
        named = F.col("source_file").isin(*names)
        before = materialized(self.contents)  # the steps below replace it
        earlier, fresh = before.where(named), materialized(content_of(store.rows_of(names)))
        after = before.where(~named).unionByName(fresh)
        months = {r.month for r in earlier.select("month").union(fresh.select("month")).distinct().collect()}
        self._publish_months(store, after, months)
        changed = earlier.select("supplier").union(fresh.select("supplier")).distinct()
        self._publish_firsts(after, None if repair else changed)
        nothing = self.spark.createDataFrame([(None, None, 0, name) for name in names], CONTENTS).join(fresh, "source_file", "left_anti")
        replace_files(fresh.unionByName(nothing), f"{self.path}/contents")

    def _publish_months(self, store: LineStore, contents: DataFrame, months: set[dt.date | None]) -> None:
        dated = [m for m in months if m is not None]
        asked = F.col("month").isin(*dated)
        holding = contents.where(asked | F.col("month").isNull() if None in months else asked).select("source_file").distinct()
        month = month_of(F.col("handover_date"))
        wanted = month.isin(*dated) | month.isNull() if None in months else month.isin(*dated)
        # Files mostly hold a month or two. Then they are read in small parts, sorted and written by one task; else gathered by month.
        held = contents.join(holding, "source_file", "left_semi").select("source_file", "month").distinct()
        held_months, files = held.agg(F.count("*"), F.count_distinct("source_file")).first()
        by_month = held_months <= _FEW_MONTHS * files and files <= _NAMED_FILES
        kept = store.rows_of([r.source_file for r in holding.collect()]) if by_month else store.read().join(holding, "source_file", "left_semi")
        with _small_parts(self.spark, _SORTED_BYTES) if by_month else nullcontext():
            publish(kept.where(wanted).select(*LINES.names), f"{self.path}/lines", by_month)
        published = F.col("handover_month")
        fresh = self.lines.where(published.isin(*dated) | published.isNull() if None in months else published.isin(*dated))
        publish_rollup(fresh.drop("handover_month"), f"{self.path}/rollup")
        held = {r.month for r in contents.where(asked | F.col("month").isNull()).select("month").distinct().collect()}
        for gone in months - held:
            remove(self.spark, f"{self.path}/lines/handover_month={gone or '__HIVE_DEFAULT_PARTITION__'}")
            remove(self.spark, f"{self.path}/rollup/month={gone or '__HIVE_DEFAULT_PARTITION__'}")

    def _publish_firsts(self, contents: DataFrame, changed: DataFrame | None) -> None:
        """First months of the changed suppliers, or of all: a file that goes may take a supplier's first month with it."""
        dated = contents.where("month is not null and supplier is not null")
        if changed is not None:
            changed = changed.where("supplier is not null")
            dated = dated.join(changed, "supplier", "left_semi")
        firsts = dated.groupBy("supplier").agg(F.min("month").alias("first_month"))
        if changed is not None:
            firsts = self.firsts.join(changed, "supplier", "left_anti").unionByName(firsts)
        materialized(firsts).write.mode("overwrite").parquet(f"{self.path}/first_months")


@dataclass(frozen=True)
class LineStore:
    """Lines by source file. With a journal every load is entered there before it writes, until its files are published."""

    spark: SparkSession
    path: str
    journal: Journal | None = None
    split_bytes: int = SPLIT_BYTES

    def read(self) -> DataFrame:
        return read_table(self.spark, self.path, LINES)

    def rows_of(self, names) -> DataFrame:
        """Lines of the named files; no other file's partition is looked into."""
        return self.read().where(F.col("source_file").isin(*names))

    def load(self, paths: list[str], aliases: DataFrame | None = None, reprocess: bool = False) -> DataFrame:
        """Load exports; returns one report row per offered path: Loaded with its rows and how many of their cells could not
        be read, Skipped (already loaded, or another path of that name is taken) or Failed with the reason. A bad file never
        stops the others, and never touches what was loaded before.

        Rows are kept by file name. Of several paths with one name the first is loaded, or the last if files are processed
        again, as if they were loaded one after the other."""
        taken: dict[str, str] = {}
        for path in paths:
            if reprocess or export_name(path) not in taken:
                taken[export_name(path)] = path
        todo = dict(taken)
        if not reprocess:
            # At most one row per offered file.
            offered = self.spark.createDataFrame([(n,) for n in taken], "source_file string")
            pending = pending_files(offered, self.rows_of(taken)).collect()
            todo = {r.source_file: taken[r.source_file] for r in pending}
        layouts, failed = self._layouts(todo, reprocess)
        if self.journal and layouts:
            self.journal.begin([export_name(path) for path in layouts])
        failed |= self._write(layouts, aliases)
        return self._report(paths, taken, todo, failed)

    def _layouts(self, todo: dict[str, str], reprocess: bool) -> tuple[dict[str, Layout], dict[str, str]]:
        """Layouts of the good files and reasons for the bad ones; the first lines are fetched concurrently. A file that
        may have stored rows is looked into for a first row, because without one there is nothing to replace them."""
        def probe(item):
            name, path = item
            try:
                return path, layout_of(self.spark, path, with_rows=reprocess), None
            except Exception as error:
                return name, None, _reason(error)

        with ThreadPoolExecutor(PROBES) as pool:
            found = list(pool.map(probe, todo.items()))
        return {k: layout for k, layout, _ in found if layout}, {k: error for k, _, error in found if error}

    def _write(self, layouts: dict[str, Layout], aliases: DataFrame | None) -> dict[str, str]:
        """One job for all files; if it fails, one for each half, down to the files at fault."""
        if not layouts:
            return {}
        try:
            known = aliases.limit(_FEW_ALIASES + 1).count() if aliases is not None else 0
            with _small_parts(self.spark, _LOADED_BYTES):
                lines = conform(read_exports(self.spark, layouts, self.split_bytes), aliases if known else None, with_unreadable=True)
                replace_files(lines, self.path, by_file=known <= _FEW_ALIASES)
            return {}
        except Exception as error:
            if len(layouts) == 1:
                return {export_name(next(iter(layouts))): _reason(error)}
        items = list(layouts.items())
        middle = len(items) // 2
        return self._write(dict(items[:middle]), aliases) | self._write(dict(items[middle:]), aliases)

    def _report(self, paths: list[str], taken: dict[str, str], todo: dict[str, str], failed: dict[str, str]) -> DataFrame:
        states, told = [], set()
        for path in paths:
            name = export_name(path)
            if path != taken[name] or path in told:
                states.append((path, name, "Skipped", f"another path has this name: {taken[name]}"))
            elif name not in todo:
                states.append((path, name, "Skipped", None))
            else:
                states.append((path, name, "Failed" if name in failed else "Loaded", failed.get(name)))
            told |= {path} if path == taken[name] else set()
        report = self.spark.createDataFrame(states, REPORT)
        loaded = [name for _, name, status, _ in states if status == "Loaded"]
        rows = read_table(self.spark, self.path, T.StructType([*LINES.fields, T.StructField(UNREADABLE, T.IntegerType())]))
        counts = rows.where(F.col("source_file").isin(*loaded)).groupBy("source_file").agg(
            F.count("*").alias("rows"), F.sum(F.coalesce(UNREADABLE, F.lit(0))).alias(UNREADABLE))
        full = report.join(counts.withColumn("status", F.lit("Loaded")), ["source_file", "status"], "left")
        empty = (F.col("status") == "Loaded") & F.col("rows").isNull()
        return full.select("source_file", F.when(empty, "Failed").otherwise(F.col("status")).alias("status"), "rows", UNREADABLE,
                           F.when(empty, "no rows").otherwise(F.col("error")).alias("error"), "path")


def _reason(error: Exception) -> str:
    return str(error).strip() or type(error).__name__
