"""Load exports as they arrive in a folder.

The stream carries file paths only; contents are read by the batch loader, so both ways of loading give
the same rows. The stream's checkpoint remembers which files were seen, and loading replaces a file's
rows, so a batch repeated after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartonwise.sources.store import LineStore


BINARY_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, folder: str, pattern: str = "*", per_batch: int | None = None) -> DataFrame:
    """Paths of new files; the file contents are not part of the plan and are never read here."""
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILES).option("pathGlobFilter", pattern)
              .option("recursiveFileLookup", "true"))
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.load(folder).select("path")


def export_paths(files: DataFrame, folders: bool = False) -> list[str]:
    """The exports behind new files, one entry each: the files themselves, or with folders the folders that Spark wrote them
    into."""
    path = F.regexp_replace("path", "/[^/]*$", "") if folders else F.col("path")
    return sorted(r.path for r in files.select(path.alias("path")).distinct().collect())


def start_ingest(store: LineStore, folder: str, checkpoint: str, aliases: DataFrame | None = None,
                 pattern: str = "*", per_batch: int | None = None, folders: bool = False) -> StreamingQuery:
    """Load everything that has arrived since the last run, then stop. folders: exports arrive as folders of parts."""
    def load(files: DataFrame, batch_id: int) -> None:
        paths = export_paths(files, folders)
        if paths:
            store.load(paths, aliases, reprocess=True)

    return (arriving_files(store.spark, folder, pattern, per_batch).writeStream
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(load).start())
