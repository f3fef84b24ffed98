"""Connected components of a graph given as a table of edges, none of it on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized


def _tied(edges: DataFrame, towards_all: bool) -> DataFrame:
    """Tie neighbours to the least vertex around: every vertex's larger neighbours (towards_all), or its smaller ones and
    itself. A vertex's least neighbour comes from an aggregation, so hubs are no hot groups."""
    if towards_all:
        ends = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = ends.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    tied = ends.join(least, "u")
    if towards_all:
        tied = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return tied.where("u <> v")


def _has_chains(edges: DataFrame) -> bool:
    """Whether a vertex u has several edges, or is the v of another one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("n"), F.lit(0).alias("centre")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    found = ends.groupBy("x").agg(F.sum("n").alias("n"), F.max("centre").alias("centre"))
    return not found.where("n > 1 or n = 1 and centre = 1").isEmpty()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vertex, component) of all edges (u, v), u > v, that one task is given."""
    above: dict[int, int] = {}

    def least(vertex: int) -> int:
        while (up := above.get(vertex, vertex)) != vertex:
            above[vertex] = vertex = above.get(up, up)
        return vertex

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one, two = least(u), least(v)
            above.setdefault(v, v)
            above[max(one, two)] = min(one, two)
            above.setdefault(u, u)
    found = list(above)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([least(x) for x in found], pa.int64())], ["vertex", "component"])


def components(edges: DataFrame, in_one_task: int = 100_000) -> DataFrame:
    """(vertex, component) of every vertex of edges (u, v): component is the least vertex reached. Up to in_one_task edges are
    joined by one task. More are turned into
    stars by alternating rounds, a number that grows with the logarithm of the longest path; each round is kept as a
    table, as lineage would otherwise grow."""
    edges = materialized(edges.where("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v")).distinct())
    if edges.count() <= in_one_task:
        return materialized(edges.coalesce(1).mapInArrow(_joined, "vertex long, component long"))
    while True:
        edges = materialized(_tied(_tied(edges, True), False).distinct())
        if not _has_chains(edges):
            break
    stars = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return materialized(stars.union(stars.select(F.col("component").alias("vertex"), "component")).distinct())
