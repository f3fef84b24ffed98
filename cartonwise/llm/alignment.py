"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which of their tokens overlap.

The ends that both token sequences have are found by galloping: the shorter list of ends drives an exponential and then a
binary search into the longer one. Common ends cut both sequences into groups; the differences of ranks between the lists are
the ranges of overlapping tokens. The arrays of many documents are searched together, no token is visited by a loop.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.ranks import Ranks
from cartonwise.llm.tables import map_texts, released

_SEGMENTS = re.compile(" *[^ ]+| +")


class ByteSide:
    """Tokens of a byte-level vocabulary."""

    def __init__(self, path: str):
        self.ranks = Ranks(path)
        tokens = {i: token for token, i in self.ranks.tokens.items()}
        self.bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of a space and each text."""
        return [np.array(self.ranks.encode(" " + text), np.uint32) for text in texts]


class PieceSide:
    """Tokens of a piece vocabulary, which puts a space before a text.

    No piece has a space after another character, so a text is cut before every run of spaces without a change of its tokens;
    each different stretch is encoded once while the store lasts. Another vocabulary encodes whole texts."""

    def __init__(self, path: str, store: int = 200_000):
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.bytes = [bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace("▁", " ").encode()
                      for i, name in enumerate(names)]
        self.cut = not any(re.search("[^▁]▁", name) for name in names)
        self.size, self.store, self.older = store, {}, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.cut:
            return [np.array(ids, np.uint32) for ids in self.pieces.encode(texts, num_threads=1)]
        stretches = [_SEGMENTS.findall(" " + text) for text in texts]
        asked = set(chain.from_iterable(stretches))
        fresh = asked.difference(self.store)
        if len(self.store) + len(fresh) > self.size:  # two generations: what is asked for again stays
            self.older, self.store, fresh = self.store, {}, asked
        again = {s: self.older[s] for s in fresh if s in self.older}
        unknown = list(fresh.difference(again))
        # The space that starts a stretch is the one the library adds, but to nothing.
        found = self.pieces.encode([s[1:] for s in unknown], num_threads=1) if unknown else []
        self.store.update(again)
        self.store.update((s, np.array(ids, np.uint32).tobytes()) for s, ids in zip(unknown, found))
        if " " in self.store:
            self.store[" "] = np.array([self.pieces.piece_to_id("▁")], np.uint32).tobytes()
        ids_of = self.store.__getitem__
        return [np.frombuffer(b"".join(map(ids_of, own)) if text else b"", np.uint32) for text, own in zip(texts, stretches)]


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value of the ascending array short, how many values of the ascending array long are less: steps that double
    from the place start until the value is passed, then a binary search within the last step."""
    size = len(long)
    if not size or not len(short):
        return np.zeros(len(short), np.int64)
    at = np.clip(start, 0, size - 1)
    upwards = long[at] < short
    low, high = np.where(upwards, at, -1), np.where(upwards, size, at)  # long[low] < value <= long[high]
    active, step = np.arange(len(short)), 1
    while len(active):
        up = upwards[active]
        probe = np.clip(np.where(up, low[active] + step, high[active] - step), -1, size)
        less = probe < 0
        inside = (probe >= 0) & (probe < size)
        less[inside] = long[probe[inside]] < short[active[inside]]
        low[active[less]], high[active[~less]] = probe[less], probe[~less]
        active, step = active[up == less], step * 2
    active = np.flatnonzero(high - low > 1)
    while len(active):
        middle = (low[active] + high[active]) >> 1
        less = long[middle] < short[active]
        low[active[less]], high[active[~less]] = middle[less], middle[~less]
        active = active[high[active] - low[active] > 1]
    return high


class Aligned(NamedTuple):
    """Tokens of several texts in one row, a after b. firsts: where each text's tokens begin, with the total at the end."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    common_a: np.ndarray  # places in a of the tokens that end where a token of b ends
    common_b: np.ndarray  # the tokens of b that end there
    link_a: np.ndarray  # places of overlapping tokens, ordered by a, then b
    link_b: np.ndarray


def _firsts(lists: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int64)


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), then the same from starts[1], and so on."""
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - before, counts)


def aligned(ids_a: list[np.ndarray], ids_b: list[np.ndarray], lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Texts whose tokens cover the same bytes on both sides, text by text; every token has a byte or more."""
    first_a, first_b = _firsts(ids_a), _firsts(ids_b)
    a, b = (np.concatenate([np.zeros(0, np.uint32), *ids]).astype(np.int64) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(lengths_a[a]), np.cumsum(lengths_b[b])
    swapped = len(ends_a) > len(ends_b)
    short, long, first_short, first_long = (ends_b, ends_a, first_b, first_a) if swapped else (ends_a, ends_b, first_a, first_b)
    # A token is looked for at its place in proportion within its text.
    counts = np.diff(first_short)
    ratio = np.diff(first_long) / np.maximum(counts, 1)
    within = np.arange(len(short)) - np.repeat(first_short[:-1], counts)
    place = gallop(short, long, np.repeat(first_long[:-1], counts) + (within * np.repeat(ratio, counts)).astype(np.int64))
    same = (long[np.minimum(place, max(len(long) - 1, 0))] == short) if len(long) else np.zeros(0, bool)
    common_short, common_long = np.flatnonzero(same), place[same]
    # A token of the short list reaches from the first token of the long one that ends after its start to the one at or after
    # its end. Its start is the end before it, whose rank is known.
    begin = np.concatenate([[0], place[:-1] + same[:-1]]).astype(np.int64) if len(place) else place
    overlaps = place - begin + 1 if len(place) else place
    link_short, link_long = np.repeat(np.arange(len(short)), overlaps), _ranges(begin, overlaps)
    if swapped:
        return Aligned(a, b, first_a, first_b, common_long, common_short, link_long, link_short)
    return Aligned(a, b, first_a, first_b, common_short, common_long, link_short, link_long)


_MARKS = ",|;"


@cache
def _written(count: int) -> list[str]:
    """Every id below count with each of _MARKS after it."""
    return [f"{i}{mark}" for i in range(count) for mark in _MARKS]


def group_texts(found: Aligned, ids: int) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of every text: the groups' ids, all below `ids`, in order."""
    na, nb = len(found.a), len(found.b)
    group_a = np.searchsorted(found.common_a, np.arange(na))  # groups before a token
    group_b = np.searchsorted(found.common_b, np.arange(nb))
    # A group's tokens of a come before its tokens of b.
    until_b = np.concatenate([[0], found.common_b + 1])
    place_a = np.arange(na) + until_b[group_a]
    place_b = np.arange(nb) + (found.common_a + 1)[group_b] if nb else np.zeros(0, np.int64)
    codes = np.empty(na + nb, np.int64)
    codes[place_a], codes[place_b] = found.a * len(_MARKS), found.b * len(_MARKS)
    codes[place_a[found.common_a]] += 1
    codes[place_b[found.common_b]] += 2
    written, codes = _written(ids).__getitem__, codes.tolist()
    firsts = (found.first_a + found.first_b).tolist()
    return ["".join(map(written, codes[s:e]))[:-1] for s, e in zip(firsts, firsts[1:])]


@cache
def _sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide, np.ndarray, np.ndarray]:
    """One pair for each Python worker."""
    a, b = ByteSide(path_a), PieceSide(path_b)

    return a, b, *(np.array([len(token) for token in side.bytes], np.int64) for side in (a, b))


def _tokens(texts: list[str | None], a: ByteSide, b: PieceSide) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Both sides' ids of each text; none where a side's bytes are not a space and the text."""
    known = [t or "" for t in texts]
    none, both = np.zeros(0, np.uint32), []
    for text, own_a, own_b in zip(known, a.encode(known), b.encode(known)):
        data = b" " + text.encode()
        same = text and all(b"".join(map(side.bytes.__getitem__, own.tolist())) == data for side, own in ((a, own_a), (b, own_b)))
        both.append((own_a, own_b) if same else (none, none))
    return [x for x, _ in both], [y for _, y in both]


_DOC = "doc_id: long, n_a: long, n_b: long, n_groups: long, n_links: long, groups_sha256: string, groups: string"
_BLOCKS = f"block long, docs array<struct<{_DOC}>>, pairs array<long>, counts array<long>, pair_of binary, count_of binary, first binary"


def _blocks(docs: DataFrame, path_a: str, path_b: str, with_groups: bool, block_bytes: int) -> DataFrame:
    """One row for every block of documents: what each document is by itself, the different pairs of ids linked in the block
    with the number of their links, and each document's own pairs (place among the block's pairs, number)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        doc = pa.struct([*numbers, ("groups_sha256", pa.string()), ("groups", pa.string())])
        schema = pa.schema([("block", pa.int64()), ("docs", pa.list_(doc)), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                            ("pair_of", pa.binary()), ("count_of", pa.binary()), ("first", pa.binary())])
        own = np.random.default_rng()  # a block's number only has to differ from others; the blocks are written before use
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (end == at or size + len(texts[end] or "") <= block_bytes):
                    size += len(texts[end] or "")
                    end += 1
                row = _block(ids[at:end], texts[at:end], path_a, path_b, with_groups)
                yield pa.RecordBatch.from_pylist([{"block": int(own.integers(0, 2**63)), **row}], schema)
                at = end

    return map_texts(docs, work, _BLOCKS)


def _block(ids: list[int | None], texts: list[str | None], path_a: str, path_b: str, with_groups: bool) -> dict:
    a, b, lengths_a, lengths_b = _sides(path_a, path_b)
    found = aligned(*_tokens(texts, a, b), lengths_a, lengths_b)
    n_a, n_b = np.diff(found.first_a), np.diff(found.first_b)
    n_groups = np.diff(np.searchsorted(found.common_a, found.first_a))
    first = np.searchsorted(found.link_a, found.first_a)
    groups = group_texts(found, max(len(lengths_a), len(lengths_b)))
    pairs, place = np.unique(found.a[found.link_a] << 32 | found.b[found.link_b], return_inverse=True)
    doc = np.repeat(np.arange(len(ids)), np.diff(first))
    own, counts = np.unique(doc * len(pairs) + place, return_counts=True)
    columns = zip(ids, n_a.tolist(), n_b.tolist(), n_groups.tolist(), np.diff(first).tolist(), groups)
    return {"docs": [{"doc_id": i, "n_a": x, "n_b": y, "n_groups": g, "n_links": n, "groups": t if with_groups else None,
                      "groups_sha256": hashlib.sha256(t.encode()).hexdigest() if t else ""} for i, x, y, g, n, t in columns],
            "pairs": pairs, "counts": np.bincount(place, minlength=len(pairs)),
            "pair_of": (own % max(len(pairs), 1)).astype("<u4").tobytes(), "count_of": counts.astype("<u4").tobytes(),
            "first": np.searchsorted(own, np.arange(len(ids) + 1) * len(pairs)).astype("<i8").tobytes()}


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, links, best): the links of every pair of ids in all documents, and whether no other pair of this b has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    counts = materialized(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("links")))
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b.alias("b")).agg(F.max("links").alias("most"))  # at most one row for each id of b
    return counts.join(most, b == F.col("b")).select(
        "pair", F.shiftright("pair", 32).alias("a"), "b", "links", (F.col("links") == F.col("most")).alias("best"))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    types = [pa.int64()] * 7 + [pa.string()] * 2
    for batch in batches:
        for at in range(batch.num_rows):
            docs, pair_of, count_of, first = (batch.column(c)[at].as_py() for c in range(4))
            known = batch.column(4)[at].values  # in the order of the pairs; null for a block without links
            links, best = ((known.field(c).to_numpy(zero_copy_only=False) for c in (1, 2)) if known is not None
                           else (np.zeros(0, np.int64), np.zeros(0, bool)))
            place, count = np.frombuffer(pair_of, "<u4"), np.frombuffer(count_of, "<u4").astype(np.int64)
            first = np.frombuffer(first, "<i8")
            sums, bests = (np.concatenate([[0], np.cumsum(count * values[place])])[first] for values in (links, best))
            own = [[d[n] for d in docs] for n in names[:5]]
            columns = [*own, np.diff(bests), np.diff(sums), [d["groups_sha256"] for d in docs], [d["groups"] for d in docs]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = True, block_bytes: int = 2 << 20) -> DataFrame:
    """For each row of docs: doc_id, n_a and n_b (tokens of a space and the text under the byte-level vocabulary path_a, and of
    the text under the piece vocabulary path_b, which adds that space), n_groups (stretches between ends that both have), n_links
    (pairs of tokens that overlap), n_best (links whose pair of ids has the most links, in all documents, of the pairs with its
    id of b; ties included), count_sum (sum over the links of their pair's links in all documents), groups_sha256 and, if asked
    for, groups (`a1,a2|b1;a3|b2,b3`). Special tokens' strings are plain text.

    A text that is null, empty or not given back by a side's tokens has no tokens: zeros and ''. Repeated rows each count and
    each get a row, also without a doc_id; other columns are not read. Counts are summed within blocks of documents
    of about block_bytes before they are shuffled, so a pair that is everywhere has one row a block; a longer text is a block."""
    spark = docs.sparkSession
    with released(spark):
        blocks = materialized(_blocks(docs, path_a, path_b, with_groups, block_bytes))
        counts = materialized(pair_counts(blocks))
    asked = blocks.select("block", F.explode("pairs").alias("pair"))
    known = asked.join(counts.select("pair", "links", "best"), "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pair", "links", "best"))).alias("known"))  # no more than a block's pairs
    rows = blocks.join(known, "block", "left").select("docs", "pair_of", "count_of", "first", "known")
    scored = rows.mapInArrow(_scored, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                      f"groups_sha256 string, groups string")
    return scored if with_groups else scored.drop("groups")
