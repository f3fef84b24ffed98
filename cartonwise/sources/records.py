"""Records of large CSV files, read by many tasks although quoted cells may hold line breaks.

A line break ends a record unless a quoted cell is open, that is, after an odd number of quotes. Spark cuts the files into
ranges of whole lines. One scan counts each range's lines with an odd number of quotes; summed up range by range, the
counts tell whether a range starts inside a quoted cell. With that known, the task that reads a range puts its records together from
their lines as they come, so no line is shuffled or kept; only the pieces of a record that reaches over ranges are shuffled and joined.

The count holds only where quotes stand around whole cells. A file in which one stands elsewhere, or which ends inside a cell, is
named so that the caller reads it whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartonwise.config import materialized

_TASK_BYTES = 64 << 20  # of ranges, which may be far smaller, that a task reads one after the other
_TASKS = 3  # for each core, of smaller files

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Records:
    """rows: file, value (a record's text, without the break at its end). irregular: files that are not among them."""

    rows: DataFrame
    irregular: set[str]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block (where a range starts) and value, a line with a break at its end. A task has whole ranges, in order."""
    value = F.when(F.endswith("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.concat(value, F.lit("\n")).alias("value"))
    size = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0  # contents are not read
    return lines.coalesce(max(_TASKS * spark.sparkContext.defaultParallelism, int(size // _TASK_BYTES) + 1))


def _by_range() -> Callable[[Batches], Iterator[tuple]]:
    """(file, block, text, edges) of lines of one range that came together: line i is text[edges[i]:edges[i + 1]]. What tasks run is nested
    in functions, so that it is sent to them whole and they need no package of ours."""

    def segments(batches: Batches) -> Iterator[tuple]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column(0).dictionary_encode()
            file, block = names.indices.to_numpy(), batch.column(1).to_numpy()
            values = batch.column(2)
            kind = np.int64 if pa.types.is_large_string(values.type) else np.int32
            edges = np.frombuffer(values.buffers()[1], kind)[values.offset:values.offset + len(values) + 1].astype(np.int64)
            text = np.frombuffer(values.buffers()[2], np.uint8)
            starts = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (block[1:] != block[:-1]))).tolist()
            for start, stop in zip(starts, [*starts[1:], len(file)]):
                own = edges[start:stop + 1]
                yield names.dictionary[int(file[start])].as_py(), int(block[start]), text[own[0]:own[-1]], own - own[0]

    return segments


def _counts(lines: DataFrame) -> DataFrame:
    """For each range its lines with an odd number of quotes, and those in which a quote stands where it may not if the range
    starts outside of a quoted cell, or inside of one. Doubled quotes don't count: of quotes in a row only the last, if they are odd in
    number, opens or closes a cell."""
    segments = _by_range()

    def count(batches: Batches) -> Batches:
        now, sums = None, [0, 0, 0]
        for file, block, text, edges in segments(batches):
            if (file, block) != now:
                if now:
                    yield row(now, sums)
                now, sums = (file, block), [0, 0, 0]
            quotes = np.flatnonzero(text == ord('"'))
            if not len(quotes):
                continue
            line = np.searchsorted(edges, quotes, "right") - 1
            odd = np.bincount(line, minlength=len(edges) - 1) % 2
            first = np.flatnonzero(np.append(True, np.diff(quotes) != 1))  # a line's break parts it from the next
            size = np.diff(np.append(first, len(quotes)))
            begin, single = quotes[first], size % 2 == 1
            begin, end, line = begin[single], (begin + size)[single], line[first][single]
            opens = (begin == edges[line]) | (text[begin - 1] == ord(","))
            closes = (end == edges[line + 1] - 1) | (text[end] == ord(","))
            number = np.arange(len(line)) - np.searchsorted(line, line)
            inside = (sums[0] + np.cumsum(odd) - odd)[line] % 2  # when the line starts, if the range starts outside
            for place in (0, 1):
                wrong = ~np.where((number + inside + place) % 2 == 0, opens, closes)
                sums[1 + place] += len(np.unique(line[wrong]))
            sums[0] += int(odd.sum())
        if now:
            yield row(now, sums)

    def row(now: tuple, sums: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"file": [now[0]], "block": [now[1]], "odds": [sums[0]], "outside": [sums[1]], "within": [sums[2]]})

    return lines.mapInArrow(count, "file string, block long, odds long, outside long, within long")


def _ranges(counted: DataFrame) -> DataFrame:
    """One row for each range of a file: whether it starts inside a cell, how many of its lines are wrong then, and the number of the
    record that reaches into it (head) or out of it (tail). A record that fills a range reaches into the next under the same number."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # over ranges, not lines
    until = Window.partitionBy("file").orderBy("block")
    inside = counted.withColumn("inside", F.coalesce(F.sum("odds").over(before), F.lit(0)) % 2 == 1)
    goes_on = F.lag(F.col("inside") & (F.col("odds") == 0)).over(until)
    begins = (F.col("inside") & ~F.coalesce(goes_on, F.lit(False))).cast("int")
    numbered = inside.withColumn("head", F.when(F.col("inside"), F.sum(begins).over(until)))
    ends_inside = (F.col("odds") + F.col("inside").cast("int")) % 2 == 1
    return numbered.withColumns({"wrong": F.when(F.col("inside"), F.col("within")).otherwise(F.col("outside")), "tail": F.lead("head").over(until),
                                 "ends_inside": ends_inside, "last": F.lead("block").over(until).isNull()})


def _assembled(lines: DataFrame, ranges: DataFrame, pieces: bool) -> DataFrame:
    """file and value of the records that lie in one range, without each file's first, the header; or with pieces, file, block, reaching
    (the head or tail that it is of), header and value of what reaches over ranges. Lines of ranges that are not given are passed over."""
    segments = _by_range()
    known: dict[str, dict[int, tuple]] = {}
    # A range for each part in which Spark reads a file, so far fewer than lines.
    for file, block, inside, head, tail in zip(*(c.to_pylist() for c in ranges.select("file", "block", "inside", "head", "tail").toArrow().columns)):
        known.setdefault(file, {})[block] = inside, head, tail
    shared = lines.sparkSession.sparkContext.broadcast(known)

    def work(batches: Batches) -> Batches:
        known = shared.value
        now, held, state = None, [], 0
        for file, block, text, edges in segments(batches):
            if (file, block) != now:
                if now and held and pieces:  # a record that reaches out of the range, or through it
                    yield piece(now, head if heading else tail, skips, held)
                now, held, mine = (file, block), [], known.get(file, {}).get(block)
                if mine:
                    state, head, tail = int(mine[0]), mine[1], mine[2]
                    heading, skips = bool(state), block == 0
            if not mine:
                continue
            line = np.searchsorted(edges, np.flatnonzero(text == ord('"')), "right") - 1
            states = (state + np.cumsum(np.bincount(line, minlength=len(edges) - 1))) % 2
            state = int(states[-1])
            ends = edges[1:][states == 0]
            if not len(ends):
                held.append(text.tobytes())
                continue
            if held or heading or skips:  # the first record that ends here
                first = held + [text[:ends[0]].tobytes()]
                if heading:
                    if pieces:
                        yield piece(now, head, False, first)
                elif not skips and not pieces:
                    yield records(file, np.array([0, sum(map(len, first))]), b"".join(first))
                skips, heading, held = skips and heading, False, []
            else:
                ends = np.append(0, ends)
            if len(ends) > 1 and not pieces:
                yield records(file, ends - ends[0], text[ends[0]:ends[-1]].tobytes())
            if ends[-1] < len(text):
                held.append(text[ends[-1]:].tobytes())
        if now and held and pieces:
            yield piece(now, head if heading else tail, skips, held)

    def records(file: str, edges: np.ndarray, text: bytes) -> pa.RecordBatch:
        values = pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(text))
        return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(file), len(values)), values], ["file", "value"])

    def piece(now: tuple, reaching: int, header: bool, texts: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        cells = (now[0], now[1], reaching, header, b"".join(texts).decode())
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], ["file", "block", "reaching", "header", "value"])

    out = lines.mapInArrow(work, "file string, block long, reaching long, header boolean, value string" if pieces else "file string, value string")
    return out.withColumn("value", F.expr("substring(value, 1, length(value) - 1)"))  # without the break at its end


def read_records(spark: SparkSession, paths: list[str]) -> Records:
    """The records of the files after their first, which is the header. They stay with the tasks that read them, but for those that reach
    over ranges."""
    lines = _lines(spark, paths)
    ranges = materialized(_ranges(_counts(lines)))
    stray = ranges.where((F.col("wrong") > 0) | F.col("last") & F.col("ends_inside"))
    irregular = {r.file for r in stray.select("file").distinct().collect()}  # offered files at most
    regular = ranges.where(~F.col("file").isin(*irregular)) if irregular else ranges
    pieces = _assembled(lines, regular.where("inside or ends_inside"), True)
    # A header that reaches into another range is one with its head there.
    joined = pieces.groupBy("file", "reaching").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "value"))), lambda p: p["value"]), "\n").alias("value"),
        F.max("header").alias("header")).where("not header")  # a record's pieces
    rows = _assembled(lines, regular, False).unionByName(joined.select("file", "value"))
    return Records(rows.where("value <> ''"), irregular)
