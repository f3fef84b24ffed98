"""Byte-level BPE with reuse of content-defined chunks.

A rolling hash over the bytes cuts each text into chunks; equal passages of different documents give equal chunks wherever
they stand. A task encodes a chunk once and looks it up afterwards. Tokens next to a cut may differ from those of the whole
text, so the stretch around each cut is encoded again, between two places where a token must end, until both ends agree
with the tokens of the chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.llm.ranks import Ranks
from cartonwise.llm.tables import map_texts

_WINDOW_DOUBLINGS = 5  # the rolling hash sees 2**5 bytes
_ROWS = 256  # texts whose ids are held at a time


@cache
def _gear() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64)


def cuts(data: np.ndarray, mean_bytes: int, least_bytes: int) -> list[int]:
    """Places where a text's bytes are cut: where the top bits of the rolling hash are zero, before a whole character, at
    least least_bytes after the last cut."""
    size = len(data)
    if size <= least_bytes:
        return []
    rolled = _gear()[data]
    with np.errstate(over="ignore"):
        for doubling in range(_WINDOW_DOUBLINGS):
            step = 1 << doubling
            rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint64(step))
    bits = mean_bytes.bit_length() - 1
    places = np.flatnonzero(rolled[:-1] >> np.uint64(64 - bits) == 0) + 1
    places = places[(data[places] & 0xC0) != 0x80]
    chosen, last = [], 0
    for place in places.tolist():
        if place - last >= least_bytes:
            chosen.append(place)
            last = place
    return chosen


class Encoder:
    """Encodes texts as a vocabulary file's tokenizer does without added tokens; its special strings become their ids."""

    def __init__(self, path: str, mean_bytes: int = 1024, least_bytes: int = 256, store_bytes: int = 8 << 20):
        self.ranks = Ranks(path)
        self.special = self.ranks.special
        self.lengths = np.zeros(max([*self.ranks.tokens.values(), *self.special.values()]) + 1, np.int64)
        for token, i in self.ranks.tokens.items():
            self.lengths[i] = len(token)
        self.mean_bytes, self.least_bytes, self.store_bytes = mean_bytes, least_bytes, store_bytes
        self.store: dict[bytes, np.ndarray] = {}
        self.older: dict[bytes, np.ndarray] = {}
        self.held = 0

    def _plain(self, data: bytes) -> np.ndarray:
        return np.array(self.ranks.encode(data.decode()), np.uint32)

    def _chunk(self, chunk: bytes) -> np.ndarray:
        """A chunk's ids from the store. The store holds two generations of store_bytes; what is asked for again stays."""
        ids = self.store.get(chunk)
        if ids is None:
            ids = self.older.get(chunk)
            if ids is None:
                ids = self._plain(chunk)
            self.held += len(chunk)
            if self.held > self.store_bytes:
                self.store, self.older, self.held = {}, self.store, len(chunk)
            self.store[chunk] = ids
        return ids

    def _segment(self, data: bytes) -> np.ndarray:
        """The ids of a text without special strings."""
        array = np.frombuffer(data, np.uint8)
        joins = cuts(array, self.mean_bytes, self.least_bytes)
        if not joins:
            return self._chunk(data) if len(data) >= self.least_bytes else self._plain(data)
        ids = np.concatenate([self._chunk(data[s:e]) for s, e in zip([0, *joins], [*joins, len(data)])])
        ends = np.cumsum(self.lengths[ids])
        # A token never covers a visible ASCII character and a space after it, whatever stands around them.
        safe = np.flatnonzero((array[1:] == 32) & (array[:-1] > 32) & (array[:-1] < 127)) + 1
        safe = np.concatenate([[0], safe, [len(data)]])
        parts, done, token = [], 0, 0
        for join in joins:
            if join < done:
                continue  # inside the stretch repaired last
            left = int(np.searchsorted(safe, join, "right")) - 1
            right = int(np.searchsorted(safe, join, "left"))
            while True:
                start, end = max(int(safe[left]), done), int(safe[right])
                first = int(np.searchsorted(ends, start, "right"))
                last = int(np.searchsorted(ends, end, "right"))
                agree_left = start in (0, done) or ends[first - 1] == start
                agree_right = end == len(data) or (last > 0 and ends[last - 1] == end)
                if agree_left and agree_right:
                    break
                left, right = left - (not agree_left), right + (not agree_right)
            if start < end:
                parts += [ids[token:first], self._plain(data[start:end])]
                token, done = last, end
        return np.concatenate([*parts, ids[token:]])

    def encode(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for place, special in self._specials(text):
            parts += [self._segment(text[at:place].encode()), np.array([self.special[special]], np.uint32)]
            at = place + len(special)
        return np.concatenate([*parts, self._segment(text[at:].encode())]).astype(np.uint32)

    def _specials(self, text: str) -> Iterator[tuple[int, str]]:
        at = 0
        while found := min(((p, -len(s), s) for s in self.special if (p := text.find(s, at)) >= 0), default=None):
            yield found[0], found[2]
            at = found[0] + len(found[2])

    def decode(self, ids: np.ndarray) -> str:
        return self.ranks.bpe.decode_bytes(ids.tolist()).decode(errors="replace")


@cache
def encoder(path: str, mean_bytes: int, least_bytes: int, store_bytes: int) -> Encoder:
    """One encoder for each Python worker, so its chunks serve all batches and tasks that the worker runs."""
    return Encoder(path, mean_bytes, least_bytes, store_bytes)


def encode(docs: DataFrame, path: str, mean_bytes: int = 1024, least_bytes: int = 256, store_bytes: int = 8 << 20,
           with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256 (the decoded text in
    UTF-8) and, if asked for, ids, for each row of docs; a null text counts as an empty one. Rows are independent: nothing is
    shuffled, repeated rows each get a row, and columns other than doc_id and text are not read."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, mean_bytes, least_bytes, store_bytes)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                yield encoded(own, batch.slice(start, _ROWS))

    def encoded(own: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [own.encode(text.as_py() or "") for text in batch.column(1)]
        counts = np.array([len(i) for i in ids], np.int64)
        columns = [batch.column(0).cast(pa.int64()), pa.array(counts),
                   pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids], pa.string()),
                   pa.array([hashlib.sha256(own.decode(i).encode()).hexdigest() for i in ids], pa.string())]
        if with_ids:
            places = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(columns)])

    return map_texts(docs, work, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """doc_id and text of rows that hold doc_id and token ids; null ids give a null text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, 1024, 256, 8 << 20)
        for batch in batches:
            texts = [None if x is None else own.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", F.col(ids).cast("array<int>").alias("ids")).mapInArrow(work, "doc_id long, text string")
