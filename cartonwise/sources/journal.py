"""Loads under way: which files a load is about to change, written before it changes anything.

Each load has an entry, a small table of its file names. The entry is deleted when the files' months are published, so an
entry that is found later tells of a load that stopped, wherever it stopped. Files are published again from the line store,
which repairs whatever the stopped load had left undone.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartonwise.config import remove

ENTRIES = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("entry", T.StringType())])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at the path; an empty one if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Journal:
    spark: SparkSession
    path: str

    def begin(self, names: list[str]) -> str:
        """Enter a load of the named files. The entry is one file, which is there whole or not at all."""
        entry = uuid.uuid4().hex
        rows = self.spark.createDataFrame([(n,) for n in names], "source_file string")
        rows.coalesce(1).write.parquet(f"{self.path}/entry={entry}")
        return entry

    def unfinished(self) -> dict[str, set[str]]:
        """Names of files by entry: those of loads that stopped, and of the one under way."""
        found: dict[str, set[str]] = {}
        for row in read_table(self.spark, self.path, ENTRIES).where(F.col("entry").isNotNull()).collect():
            found.setdefault(row.entry, set()).add(row.source_file)
        return found

    def finish(self, entries) -> None:
        """Files of the entries are published. Deleting a part of the entries is harmless: the others are published again."""
        for entry in entries:
            remove(self.spark, f"{self.path}/entry={entry}")
