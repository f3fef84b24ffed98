"""Export files -> typed, derived lines."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartonwise.functions.text import clean_text
from cartonwise.schema import HEADERS, INTEGER_COLUMNS, LINE_COLUMNS, LINES, MANDATORY_HEADER, TIME_COLUMNS
from cartonwise.sources.derive import derive
from cartonwise.sources.records import read_records


# Date texts that are read besides ISO ones, the first that fits; a time may follow. Where day and month could be either, the
# month comes first.
DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "d/M/yyyy", "d.M.yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy")
_MARKS = {f: next(mark for mark in ",/.- " if mark in f) for f in DATE_FORMATS}
_FOLDER = "source_file="  # Spark's name of a folder begins with it
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
UNREADABLE = "unreadable_cells"
# CSV files over this size are read by several tasks, as Spark reads a file of several partitions.
SPLIT_BYTES = 128 << 20


class BadExport(ValueError):
    """A file that is not a transaction export."""


@dataclass(frozen=True)
class Layout:
    """What exports must share to be read by one scan."""

    header: tuple[str, ...]
    parquet: bool
    folder: bool  # written by Spark in parts: the export is the folder


_QUOTING = {"quote": '"', "escape": '"'}


def _reader(spark: SparkSession):
    # Quoted cells may hold line breaks, so a file read in this way is read by one task: files up to SPLIT_BYTES.
    return spark.read.option("header", True).options(**_QUOTING).option("multiLine", True)


def layout_of(spark: SparkSession, path: str, with_rows: bool = False) -> Layout:
    """The layout of one export; only its first line (CSV) or footer (Parquet) is read. `with_rows` also asks for a
    first row."""
    parquet = path.endswith(".parquet")
    cells = spark.read.parquet(path) if parquet else _reader(spark).csv(path)
    if MANDATORY_HEADER not in cells.columns:
        raise BadExport(f"no column {MANDATORY_HEADER!r}")
    if with_rows and cells.isEmpty():
        raise BadExport("no rows")
    own = path.rstrip("/").rsplit("/", 1)[-1]
    files = [unquote(f).rsplit("/", 2)[1:] for f in cells.inputFiles()]
    return Layout(tuple(cells.columns), parquet, not (len(files) == 1 and files[0][1] == own and files[0][0] != own))


def export_name(path: str) -> str:
    """Name under which an export's rows are kept: its file name, or that of the folder Spark wrote it into."""
    return path.rstrip("/").rsplit("/", 1)[-1].removeprefix("source_file=")


def _source_file(folder: bool, path: str = "_metadata.file_path") -> Column:
    name = F.substring_index(path, "/", -1)
    if folder:
        name = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    # Worked out for every line, so names without escapes are taken as they are.
    name = F.when(F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)
    return F.when(F.startswith(name, F.lit(_FOLDER)), F.substring(name, len(_FOLDER) + 1, 1 << 30)).otherwise(name)


def large_files(spark: SparkSession, paths: list[str], split_bytes: int) -> list[str]:
    """CSV files behind the paths that are larger than split_bytes; only their sizes are read."""
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(paths).where(F.col("length") > split_bytes)
    sizes = sizes.where("path not like '%.gz'")  # can't be cut
    return sorted(r.path for r in sizes.select("path").collect())  # at most the files of the exports offered


def read_layout(spark: SparkSession, paths: list[str], layout: Layout, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Raw cells of exports of one layout, under target names; headers that are absent become nulls and unknown ones are
    ignored. The large files among CSV exports are cut into records by many tasks, unless their quotes do not allow it."""
    if layout.parquet:
        return select_cells(spark.read.parquet(*paths).withColumn("source_file", _source_file(layout.folder)))
    schema = ", ".join(f"`{h.replace('`', '``')}` string" for h in layout.header)
    large = large_files(spark, paths, split_bytes)
    found = read_records(spark, large) if large else None
    split = {spark_path(f) for f in large} - {spark_path(f) for f in found.irregular} if found else set()
    whole = paths if not split else [f for f in csv_files(spark, paths) if spark_path(f) not in split]
    parts = []
    if whole:
        parts.append(_reader(spark).schema(schema).csv(whole).withColumn("source_file", _source_file(layout.folder)))
    if split:
        cells = found.rows.select("file", F.from_csv("value", schema, _QUOTING).alias("cells"))
        parts.append(cells.select("cells.*", _source_file(layout.folder, "file").alias("source_file")))
    return select_cells(reduce(DataFrame.unionByName, parts))


def csv_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files behind the paths, which may be folders."""
    return [unquote(f) for f in _reader(spark).schema("cell string").csv(paths).inputFiles()]


def spark_path(path: str) -> str:
    """One form of a file's path, which Spark gives with escapes in some places and without in others."""
    return unquote(path).replace("file:///", "file:/")


def select_cells(cells: DataFrame) -> DataFrame:
    present = set(cells.columns)

    def cell(header):
        quoted = f"`{header.replace('`', '``')}`"
        return F.col(quoted).cast("string") if header in present else F.lit(None).cast("string")

    return cells.select(*(cell(h).alias(name) for h, name in HEADERS.items()), "source_file")


def read_exports(spark: SparkSession, layouts: dict[str, Layout], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Raw cells of many exports (path -> layout): one scan per distinct layout, not per file."""
    paths: dict[Layout, list[str]] = {}
    for path, layout in layouts.items():
        paths.setdefault(layout, []).append(path)
    return reduce(DataFrame.unionByName, (read_layout(spark, own, layout, split_bytes) for layout, own in paths.items()))


def canonical_supplier(rows: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Replace known raw names (exact match after trimming) by their canonical name. The alias table is broadcast
    only while it is below the session's size limit."""
    trimmed = rows.withColumn("supplier", F.trim("supplier"))
    if aliases is None:
        return trimmed
    found = trimmed.join(aliases, F.col("supplier") == F.col("raw_name"), "left")
    return found.select(*(F.coalesce("canonical_name", "supplier").alias("supplier") if c == "supplier" else c
                          for c in rows.columns))


def _number(cell: Column) -> Column:
    """A plain decimal number, or null: the cast alone would also take the suffixes and names that Java knows."""
    return F.when(cell.rlike(_NUMBER), cell.try_cast("double"))


def _other_dates(cell: Column) -> list[Column]:
    """The cell by each format; a format is tried only if the cell has the mark between its parts, as a failed try costs more than a
    search."""
    return [F.when(F.contains(cell, F.lit(_MARKS[f])), F.try_to_timestamp(cell, F.lit(f"{f}[ H:mm[:ss]]"))) for f in DATE_FORMATS]


def _wall_clock(cell: Column) -> Column:
    """The time as written, whatever its zone."""
    return F.coalesce(cell.try_cast("timestamp_ntz"), *(d.cast("timestamp_ntz") for d in _other_dates(cell)))


def conform(raw: DataFrame, aliases: DataFrame | None = None, with_unreadable: bool = False) -> DataFrame:
    """Raw text cells -> lines. A cell that cannot be read as its type, or whose value does not fit it, becomes null, never
    an error; with_unreadable adds how many of a line's cells these are. Volume and density use the numbers as written;
    integers are rounded only when stored."""
    text = raw.select(*(clean_text(F.col(c)).alias(c) if c != "source_file" else F.col(c) for c in raw.columns))
    named = canonical_supplier(text, aliases)
    dated = {"handover_date": _wall_clock(F.col("handover_date")).cast("date"),
             **{c: F.coalesce(F.col(c).try_cast("timestamp"), *_other_dates(F.col(c))) for c in TIME_COLUMNS}}
    read = {c: _number(F.col(c)) for c in INTEGER_COLUMNS} | dated
    lost = sum((F.col(c).isNotNull() & value.isNull()).cast("int") for c, value in read.items())
    typed = named.withColumns({**read, "_updated": _wall_clock(F.col("updated_date")), UNREADABLE: lost})
    lines = derive(typed, F.col("_updated"))
    stored = lines.withColumns({c: F.bround(c, 0).try_cast("int") for c in INTEGER_COLUMNS})
    return stored.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in LINES.fields), *([UNREADABLE] if with_unreadable else []))


def to_export(lines: DataFrame) -> DataFrame:
    """Lines as export cells: the inverse of conform, all text, under the export headers."""
    assert set(HEADERS.values()) <= set(LINE_COLUMNS)
    return lines.select(*(F.col(name).cast("string").alias(header) for header, name in HEADERS.items()),
                        "source_file")
