"""Removal of repeated byte strings by suffix sorting.

A byte goes if a window of 50 bytes over it also starts in a document of a smaller doc_id. All windows of all texts are
suffixes that would have to be sorted; three steps leave few of them and spread these over the cluster:

1. In each window one key is marked, the 16 bytes with the least hash, so equal windows mark the same key at the same place.
   Keys that only one document has are dropped; about one place in 18 is marked, and of these the repeated ones are kept.
2. All windows that mark a key lie within its context, 34 bytes on each side. Each different context of a key goes to the task
   of the key's bucket once, with the least doc_id that has it.
3. There the suffixes that start at the keys, and the reversed bytes before the keys, are sorted by deep-shallow sorting. Two
   contexts share a window if they share enough of both, which the common prefixes of the two orders tell for every window.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm import text_arrays
from cartonwise.llm.deep_shallow import deep_shallow
from cartonwise.llm.tables import discard, map_texts, released

_BATCH = "4m"  # of texts or marks handed to a task's Python worker at a time
_CHUNK = 1 << 19  # bytes of text whose arrays are held at a time
_TOGETHER = 50_000  # contexts sorted at a time, and then the rest of the last key's
_LAST = 2**63 - 1


class Marks(NamedTuple):
    """Marked keys: the text (by its place in the batch), the key's place in it, the bytes around it that a window can reach,
    and hashes of the key and of the key with these bytes."""

    text: np.ndarray
    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    key: np.ndarray
    context: np.ndarray


def _over(values: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """of (minimum or maximum) over every run of `width` values."""
    done = 1
    while done * 2 <= width:
        values = of(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return of(values[:-rest], values[rest:]) if rest else values


def _marks_of(data: np.ndarray, offsets: np.ndarray, key_bytes: int, window: int, first: int, end: int) -> Marks | None:
    """The marks of the windows that start from `first` up to `end`, both places in data."""
    size, reach = len(data), window - key_bytes
    if size < window:
        return None
    up, down = text_arrays._powers(1 << max(12, (size - 1).bit_length()))
    sums = np.zeros(size + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(text_arrays._byte_values(False)[data] * up[:size], out=sums[1:])
        hashes = text_arrays.mix((sums[key_bytes:] - sums[:-key_bytes]) * down[:size - key_bytes + 1])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    least = _over(hashes, reach + 1, np.minimum)
    least[text[:len(least)] != text[window - 1:]] = 0  # a window that would cross texts
    least[:first] = 0
    least[end:] = 0
    # A key is marked if one of the windows around it has its hash as the least.
    around = _over(np.concatenate([np.zeros(reach, np.uint64), least, np.zeros(reach, np.uint64)]), reach + 1, np.maximum)
    place = np.flatnonzero((around == hashes) & (around > 0))
    own = text[place]
    start, stop = np.maximum(offsets[own], place - reach), np.minimum(offsets[own + 1], place + window)
    left, right = place - start, stop - place - key_bytes
    with np.errstate(over="ignore"):
        content = (sums[stop] - sums[start]) * down[start]
        context = text_arrays.mix(content ^ text_arrays.mix((left * window + right + 1).astype(np.uint64)))
    # Mixed again, as the least hashes are small ones and would fill a few buckets only.
    return Marks(own, place - offsets[own], left, right, text_arrays.mix(hashes[place]), context)


def marks(texts: pa.Array, key_bytes: int, window: int) -> Marks:
    """The marks of a column of texts; a long text is worked through in slices."""
    found = []
    for at, end, data, offsets in text_arrays.texts_of(texts, _CHUNK):
        if len(data) <= 2 * _CHUNK:
            own = _marks_of(data, offsets, key_bytes, window, 0, len(data))
            if own:
                found.append(own._replace(text=own.text + at))
            continue
        sliced = []
        for first in range(0, len(data), _CHUNK):
            low, high = max(0, first - window), min(len(data), first + _CHUNK + 2 * window)
            own = _marks_of(data[low:high], np.array([0, high - low]), key_bytes, window, first - low, first - low + _CHUNK)
            if own:
                sliced.append(own._replace(text=own.text + at, place=own.place + low))
        if sliced:  # neighbouring slices may mark the same key
            whole = Marks(*map(np.concatenate, zip(*sliced)))
            _, once = np.unique(whole.place, return_index=True)
            found.append(Marks(*(x[once] for x in whole)))
    if not found:
        none = np.zeros(0, np.int64)
        return Marks(none, none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    return Marks(*map(np.concatenate, zip(*found)))


def _buckets(key: np.ndarray, count: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)


def _parts(sorted_buckets: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The bucket and place of each run of equal numbers."""
    if len(sorted_buckets):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(sorted_buckets)) + 1, [len(sorted_buckets)]]).tolist()
        for start, end in zip(edges, edges[1:]):
            yield int(sorted_buckets[start]), slice(start, end)


def _rows(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), types)], names)


def _repeated_keys(texts: DataFrame, buckets: int, key_bytes: int, window: int) -> DataFrame:
    """(bucket, keys, marks): the low halves of the key hashes that more than one row has, in order, and the number of all marks.
    A batch sends each key once, or twice if two of its rows have it."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = marks(batch.column(1), key_bytes, window)
            by_key = np.argsort(found.key, kind="stable")  # and by row
            key, row = found.key[by_key], found.text[by_key]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            counts = np.diff(np.concatenate([starts, [len(key)]]))
            shared = row[starts] != row[starts + counts - 1]
            low, bucket = key[starts].astype("<u4"), _buckets(key[starts], buckets)
            yield _rows(["bucket", "keys", "marks"], [pa.int64(), pa.binary(), pa.int64()],
                        [(b, np.repeat(low[part], 1 + shared[part]).tobytes(), int(counts[part].sum())) for b, part in _parts(bucket)])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bucket, lists, count in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                keys = np.sort(np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in lists.values]))
                out.append((bucket, np.unique(keys[1:][keys[1:] == keys[:-1]]).tobytes(), count))
            yield _rows(["bucket", "keys", "marks"], [pa.int64(), pa.binary(), pa.int64()], out)

    lists = map_texts(texts, sent, "bucket long, keys binary, marks long", ("row_key", "text"), _BATCH).groupBy("bucket").agg(
        F.collect_list("keys").alias("keys"), F.sum("marks").alias("marks"))
    return lists.mapInArrow(kept, "bucket long, keys binary, marks long")


# The arrays of a packed row, each with its type; docs and row_keys have an item for each row, the others for each mark.
_ARRAYS = (("docs", "<i8"), ("row_keys", "<i8"), ("contexts", "<i8"), ("keys", "<u4"), ("rows", "<u4"), ("places", "<u4"), ("sides", "<u4"))


def _pack(arrays: list[np.ndarray]) -> bytes:
    sizes = np.array([len(arrays[0]), len(arrays[2])], "<i8")
    return b"".join([sizes.tobytes(), *(x.astype(t, copy=False).tobytes() for x, (_, t) in zip(arrays, _ARRAYS))])


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    rows, count = np.frombuffer(data, "<i8", 2).tolist()
    out, at = {}, 16
    for name, kind in _ARRAYS:
        out[name] = np.frombuffer(data, kind, rows if name in ("docs", "row_keys") else count, at)
        at += out[name].nbytes
    return out


def _occurrences(texts: DataFrame, repeated: DataFrame, buckets: int, key_bytes: int, window: int, most_marks: int) -> DataFrame:
    """(key, context, doc, row_key, place, left, right) of every mark whose key is repeated; key holds the bucket too.

    Marks travel packed by batch and bucket, and meet the bucket's repeated keys, which come first, in one task. A bucket with
    over most_marks marks, which a hot key makes, is dealt over several tasks, each with the repeated keys."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row_key, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 2))
            _, once = np.unique(row_key, return_index=True)  # copies of a row have the same marks
            found = marks(batch.column(1), key_bytes, window)
            if len(once) < len(row_key):
                found = Marks(*(x[np.isin(found.text, once)] for x in found))
            bucket = _buckets(found.key, buckets)
            order = np.argsort(bucket, kind="stable")  # and by row and place
            out = []
            for b, part in _parts(bucket[order]):
                own = order[part]
                rows, dense = np.unique(found.text[own], return_inverse=True)
                data = _pack([doc[rows], row_key[rows], found.context[own].view(np.int64), found.key[own] & np.uint64(0xFFFFFFFF), dense,
                              found.place[own], found.left[own] << 16 | found.right[own]])
                out.append((b, int(row_key[rows[0]]), data))
            yield _rows(["bucket", "batch", "data"], [pa.int64(), pa.int64(), pa.binary()], out)

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, known = None, None
        for batch in batches:
            for bucket, first, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if first:
                    at, known = bucket, np.frombuffer(data.as_py(), "<u4")
                if first or at != bucket or not len(known):
                    continue
                found = _unpack(data.as_py())
                near = np.minimum(np.searchsorted(known, found["keys"]), len(known) - 1)
                own = np.flatnonzero(known[near] == found["keys"])
                row, side = found["rows"][own], found["sides"][own].astype(np.int32)
                columns = [bucket << 32 | found["keys"][own].astype(np.int64), found["contexts"][own], found["docs"][row], found["row_keys"][row],
                           found["places"][own].astype(np.int32), side >> 16, side & 0xFFFF]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                                 ["key", "context", "doc", "row_key", "place", "left", "right"])

    deals = F.ceil(F.col("marks") / most_marks).cast("int")
    hot = materialized(repeated.where(F.col("marks") > most_marks).select("bucket", deals.alias("deals")))
    keys = repeated.select("bucket", F.explode(F.sequence(F.lit(1), deals)).alias("deal"), F.lit(True).alias("first"), F.col("keys").alias("data"))
    sent = map_texts(texts, packed, "bucket long, batch long, data binary", ("row_key", "text", "doc"), _BATCH)
    sent = sent.join(hot, "bucket", "left").select(
        "bucket", (F.pmod("batch", F.coalesce("deals", F.lit(1))) + 1).cast("int").alias("deal"), F.lit(False).alias("first"), "data")
    dealt = keys.unionByName(sent).repartition("bucket", "deal").sortWithinPartitions("bucket", "deal", F.desc("first"))
    return dealt.select("bucket", "first", "data").mapInArrow(
        flat, "key long, context long, doc long, row_key long, place int, left int, right int")


_CONTEXT = "key long, context long, doc long, several boolean, hot boolean, left int, right int"


def _contexts(texts: DataFrame, wanted: DataFrame, key_bytes: int) -> DataFrame:
    """The bytes of each wanted context, cut from the first row that has it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, asked in zip(batch.column(0), batch.column(1)):
                data = text.as_py().encode()
                own = pa.RecordBatch.from_struct_array(asked.values)
                places, left, right = (own.column(c).to_pylist() for c in ("place", "left", "right"))
                content = pa.array([data[p - x:p + key_bytes + y] for p, x, y in zip(places, left, right)], pa.binary())
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], content], [*own.schema.names[:-1], "bytes"])

    one = texts.groupBy("row_key").agg(F.any_value("text").alias("text"))  # repeated rows are one text
    names = [c.split()[0] for c in _CONTEXT.split(", ")]
    lists = wanted.groupBy("row_key").agg(F.collect_list(F.struct(*names, "place")).alias("asked"))  # of one text
    return one.join(lists, "row_key").select("text", "asked").mapInArrow(cut, f"{_CONTEXT}, bytes binary")


class Sorted(NamedTuple):
    """The classes of strings with a common prefix, read off their order."""

    order: np.ndarray
    common: np.ndarray

    def classes(self, length: int) -> np.ndarray:
        """A number for each string; those that share their first `length` bytes have the same one."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.common < length)
        return out


def _matrix(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, step: int, width: int) -> np.ndarray:
    """A row of bytes for each string: data from starts on, forwards or (step -1) backwards, zero after its length."""
    columns = np.arange(-(-max(width, 1) // 8) * 8)
    places = starts[:, None] + step * columns
    inside = columns < lengths[:, None]
    return np.where(inside, data[np.where(inside, places, 0)] if len(data) else 0, 0).astype(np.uint8)


def least_documents(contents: pa.Array, left: np.ndarray, doc: np.ndarray, key_bytes: int, window: int) -> np.ndarray:
    """For each context and each number of bytes before its key (0 up to window - key_bytes), the least document of all contexts
    that share the window that starts there; _LAST where a context has no such window."""
    reach, count = window - key_bytes, len(doc)
    contents = contents.cast(pa.large_binary())
    offsets = np.frombuffer(contents.buffers()[1], np.int64)[contents.offset:contents.offset + count + 1]
    data = np.frombuffer(contents.buffers()[2], np.uint8) if count and contents.buffers()[2] is not None else np.zeros(0, np.uint8)
    keys, length = offsets[:-1] + left, np.diff(offsets) - left
    after = Sorted(*deep_shallow(_matrix(data, keys, length, 1, window), length))
    before = Sorted(*deep_shallow(_matrix(data, keys - 1, left, -1, reach), left))
    least = np.full((count, reach + 1), _LAST)
    # A context whose neighbours in the order have other keys shares no window.
    near = np.concatenate([after.common >= key_bytes, [False]])
    sharing = np.zeros(count, bool)
    sharing[after.order] = near[:-1] | near[1:]
    alone = np.flatnonzero(~sharing)
    places = np.arange(reach + 1)
    least[alone] = np.where((places <= left[alone, None]) & (places >= window - length[alone, None]), doc[alone, None], _LAST)
    for taken in range(reach + 1):
        own = np.flatnonzero(sharing & (left >= taken) & (length >= window - taken))
        if not len(own):
            continue
        shared = before.classes(taken)[own] * (count + 1) + after.classes(window - taken)[own]
        order = np.argsort(shared)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(shared[order]) != 0]))
        values = np.minimum.reduceat(doc[own][order], starts)
        least[own[order], taken] = np.repeat(values, np.diff(np.concatenate([starts, [len(own)]])))
    return least


_RUNS = "key long, context long, runs array<struct<low: int, high: int, first: long>>"


def _resolved(contexts: DataFrame, key_bytes: int, window: int, together: int) -> DataFrame:
    """(key, context, runs): for the bytes taken before the key from low up to high, the least document of the window. Runs
    that no document of this context is later than are left out. A key's contexts are sorted together, in one task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < together:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table["key"].to_numpy()
            end = int(np.flatnonzero(key != key[-1]).max(initial=-1)) + 1  # of the last key more may come
            if end:
                yield runs(table.slice(0, end))
                held, count = table.slice(end).to_batches(), len(key) - end
        if held:
            yield runs(pa.Table.from_batches(held))

    def runs(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        left, doc, several = (table[c].to_numpy() for c in ("left", "doc", "several"))
        contents = table["bytes"].combine_chunks()
        contents = contents if isinstance(contents, pa.Array) else pa.concat_arrays(contents.chunks)
        least = least_documents(contents, left.astype(np.int64), doc, key_bytes, window)
        new = np.concatenate([np.ones((len(doc), 1), bool), least[:, 1:] != least[:, :-1]], axis=1)
        row, low = np.nonzero(new)
        high = np.concatenate([low[1:], [0]]) - 1
        high[high < low] = window - key_bytes  # the last run of a context
        first = least[row, low]
        of_use = (first < doc[row]) | (first == doc[row]) & several[row]
        row, low, high, first = row[of_use], low[of_use], high[of_use], first[of_use]
        kept = np.unique(row)
        struct = pa.StructArray.from_arrays([pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(first)], ["low", "high", "first"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([np.searchsorted(row, kept), [len(row)]]), pa.int32()), struct)
        taken = [table[c].combine_chunks().take(pa.array(kept)) for c in ("key", "context")]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in taken] + [lists],
                                          ["key", "context", "runs"])

    dealt = contexts.repartition("key").sortWithinPartitions("key")
    return dealt.select("key", "context", "doc", "several", "left", "bytes").mapInArrow(work, _RUNS)


def _resolved_by_window(contexts: DataFrame, key_bytes: int, window: int) -> DataFrame:
    """The same for keys with too many contexts for one task: every window of them is grouped by its bytes."""
    taken = F.sequence(F.greatest(F.lit(0), F.lit(window - key_bytes) - F.col("right")), F.least(F.col("left"), F.lit(window - key_bytes)))
    each = contexts.select("key", "context", "doc", "several", "left", "bytes", F.explode(taken).alias("low"))
    each = each.withColumn("window", F.expr(f"substring(bytes, left - low + 1, {window})"))
    least = each.groupBy("window").agg(F.min("doc").alias("first"))
    known = each.join(least, "window").where("first < doc or first = doc and several")
    return known.groupBy("key", "context").agg(F.collect_list(F.struct("low", F.col("low").alias("high"), "first")).alias("runs"))


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of byte ranges as maximal ranges in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(reach) - 1]])]


_KEPT = "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        rows = []
        for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = (text.as_py() or "").encode()
            values = found.values
            if values is None or not len(values):
                rows.append((doc_id, len(data), [], data))
                continue
            starts, ends = _merged(values.field(0).to_numpy(), values.field(1).to_numpy())
            kept = b"".join([data[s:e] for s, e in zip([0, *ends.tolist()], [*starts.tolist(), len(data)])])
            rows.append((doc_id, len(data), [{"start": s, "end": e} for s, e in zip(starts.tolist(), ends.tolist())], kept))
        yield _rows(["doc_id", "n_bytes", "spans", "kept"], [pa.int64(), pa.int64(), span, pa.binary()], rows)


def remove_repeats(docs: DataFrame, window: int = 50, key_bytes: int = 16, bucket_bytes: int = 4 << 20, most_contexts: int = 20_000,
                   together: int = _TOGETHER) -> DataFrame:
    """For each row of docs: doc_id, n_bytes, spans (maximal removed ranges of bytes) and kept (the other bytes, which may part a
    character). A byte of a text is removed if a string of `window` bytes over it also starts in a document of a smaller doc_id;
    all is judged on the texts as given. A null text counts as an empty one. Rows of one doc_id remove nothing from each
    other, whatever their texts; a null doc_id is larger than every other. Other columns are not read.

    bucket_bytes: text whose marked keys are compared in one task. A key with over most_contexts different contexts is resolved
    window by window instead, to the same result."""
    spark = docs.sparkSession
    texts = docs.select(F.xxhash64("doc_id", "text").alias("row_key"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"))
    with released(spark):
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(1, -(-size // bucket_bytes))
        repeated = materialized(_repeated_keys(texts, buckets, key_bytes, window))
        most_marks = 4 * (1 + bucket_bytes * 2 // (window - key_bytes + 2))  # of the marks to expect in a bucket
        found = materialized(_occurrences(texts, repeated, buckets, key_bytes, window, most_marks))
        # The place of a context's bytes: any row's, and all of it from the same row.
        place = [F.first(c).alias(c) for c in ("row_key", "place", "left", "right")]
        several = (F.min("doc") < F.max("doc")).alias("several")
        different = materialized(found.groupBy("key", "context").agg(F.min("doc").alias("doc"), several, *place))
        hot = materialized(different.groupBy("key").count().where(F.col("count") > most_contexts).select("key", F.lit(True).alias("hot")))
        marked = different.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        discard(repeated)
        contexts = materialized(_contexts(texts, marked, key_bytes))
        discard(different)
        resolved = materialized(_resolved(contexts.where("not hot"), key_bytes, window, together).unionByName(
            _resolved_by_window(contexts.where("hot"), key_bytes, window)))
        discard(contexts, hot)
        later = F.filter("runs", lambda r: r["first"] < F.col("doc"))
        spans = F.transform(later, lambda r: F.struct((F.col("place") - r["high"]).alias("start"), (F.col("place") - r["low"] + window).alias("end")))
        ranges = found.join(resolved, ["key", "context"]).select("row_key", F.explode(spans).alias("span"))
        removed = materialized(ranges.groupBy("row_key").agg(F.collect_set("span").alias("removed")))  # of one text
        discard(found, resolved)
    rows = texts.join(removed, "row_key", "left").select(F.nullif("doc", F.lit(_LAST)).alias("doc_id"), "text", "removed")
    return rows.mapInArrow(_without, _KEPT)


def digests(docs: DataFrame) -> DataFrame:
    """remove_repeats, with what is kept as a SHA-256 digest and the spans as numbers."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return remove_repeats(docs).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"))
