"""Tables and texts as the queries read them, and frames of several operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartonwise.config import remove

WORD_SPACE = "[ \\t\\n\\x0B\\f\\r]+"
BLANKS = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that no label is learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """For steps whose results are written as tables. Within it, Spark deletes the shuffle files of a job when the job ends, so that
    those of earlier steps don't pile up beside the tables; a result that is asked for again is computed again. The tables are
    packed tighter than by default."""
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def discard(*written: DataFrame) -> None:
    """Delete tables that `materialized` wrote, when all that reads them has run."""
    for table in written:
        for file in table.inputFiles()[:1]:
            remove(table.sparkSession, file.rsplit("/", 1)[0])


def small_batches(spark: SparkSession, rows: int = 2000, size: str = "4m") -> None:
    """Python workers get at most so many rows and about so many bytes at a time, as texts are long: they and the executor
    beside them then hold a few megabytes of a table, not a tenth of a partition each."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def map_texts(docs: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType,
              columns: tuple[str, ...] = ("doc_id", "text"), size: str = "4m") -> DataFrame:
    """work over Arrow batches (of about `size`) of the named columns only: whatever else docs has cannot clash with the result."""
    small_batches(docs.sparkSession, size=size)
    return docs.select(*columns).mapInArrow(work, schema)


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct, so that their names clash with nothing that is joined."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns))


def drop_ids(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is not in dropped, whatever other columns docs has. A null doc_id stays."""
    gone = dropped.select(F.col("doc_id").alias("_gone")).distinct()
    rows = docs.select(whole_row(docs).alias("row"))
    return rows.join(gone, F.col("row.doc_id") == F.col("_gone"), "left_anti").select("row.*")
