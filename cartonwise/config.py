"""Business rules, passed explicitly so a caller can change them without touching code."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

# The countries of region BD; every other country is region CN.
BD_COUNTRIES = ("Bangladesh", "India", "Pakistan", "Sri Lanka", "Morocco", "Turkey")

# Days off per region, counted as weekday() does (Monday = 0).
WEEKENDS = MappingProxyType({"BD": (4, 5), "CN": (5, 6)})


class NoData(ValueError):
    """The month or the suppliers asked for have no lines."""


@dataclass(frozen=True)
class Rules:
    """Thresholds are percentages and are tested on the unrounded rate unless a metric says otherwise."""

    bd_countries: tuple[str, ...] = BD_COUNTRIES
    weekends: MappingProxyType = field(default=WEEKENDS, hash=False)
    top_rate: float = 95.0
    follow_up_rate: float = 40.0
    high_band: float = 70.0
    mid_band: float = 40.0
    heat_low: float = 40.0
    heat_mid: float = 60.0
    chart_months: int = 12


def session_setup(spark: SparkSession) -> SparkSession:
    """Settings the results depend on or the plans rely on; all can be changed on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    # The JVM interprets larger methods instead of compiling them; Spark splits the expressions of such a stage.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


# Options of a write of very many small files. On a local or mounted disk Hadoop writes a checksum file beside each file, and without its
# native library sets the rights of every folder, file and checksum file in a process of its own; as plain files, these get
# the rights that the system gives. On other file systems the options change nothing.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_LISTINGS = 4  # tasks for each core that list folders


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def many_folders(spark: SparkSession) -> Iterator[None]:
    """For opening a table of very many folders: Spark lists them with up to 10,000 tasks, of a folder or two each, for every folder that
    holds them. Here tasks are few and list many."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    few = min(int(spark.conf.get(key)), _LISTINGS * spark.sparkContext.defaultParallelism)
    with setting(spark, key, str(few)):
        yield


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a session without one (a test) gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = os.path.join(tempfile.gettempdir(), f"cartonwise-{uuid.uuid4().hex}")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whatever file system it is, if it exists."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


_SCRATCH: list[str] = []


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables that jobs of this driver kept in the shared folder; call it when their results have been read."""
    while _SCRATCH:
        remove(spark, _SCRATCH.pop())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder for a table that a job writes and reads back."""
    _SCRATCH.append(f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def materialized(df: DataFrame) -> DataFrame:
    """df computed once and kept as a table in the shared folder, for an aggregate that several results start from. Unlike
    a cache it outlives the executors that computed it, and readers fetch only the columns they need."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
