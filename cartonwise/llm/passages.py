"""Passages that repeat, also with small changes, in several documents: seeds, chains and alignments.

Runs of five words are hashed and of every few neighbouring ones the least is a seed. A seed is joined to the first document
that has it, not to all others, so a passage in a thousand documents makes a thousand links. As the parts of a passage may
stand first in other documents, sequences of seeds within up to 18 and 36 words are also joined to the first document that
has them, and where the seeds of a stretch don't lead to one and the same place, every run of as many words as a passage has at least
is joined to the first document that has it: a passage that an earlier document has word for word is always linked. Links between two documents in the same order in both are chained, a Fenwick tree giving the best predecessor at linear gap costs, and the words in and
around a chain are aligned.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.leaks import longest_common_subsequence
from cartonwise.llm.tables import map_texts
from cartonwise.llm.text_arrays import Words, mix, shingle_hashes, texts_of

SEED_WORDS = 5
SEED_WINDOW = 4  # of so many neighbouring runs of words the least is a seed
_STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_THINNED = 8  # words between the links that stay of a stretch that is equal word for word
_CONTEXTS = (18, 36)  # words of a sequence of seeds that is linked as a whole
_GAP_COST = 0.05  # for each word left out on either side, where a seed counts its words
_WIDEST_GAP = 32  # a wider gap between neighbouring seeds ends a chain unless half of its words agree
_AROUND = 48  # words around a chain into which it may grow; seeds lie closer
_GRID = 32  # slices start and end on it, so that chains share them


def seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of a text's seeds. Of equal neighbouring runs only the first counts, so a repeated word is one."""
    hashes = shingle_hashes(words, SEED_WORDS)
    count = len(hashes)
    if not count:
        return hashes, np.zeros(0, np.int32)
    width = min(SEED_WINDOW, count)
    least = hashes[:count - width + 1].copy()
    for place in range(1, width):
        np.minimum(least, hashes[place:count - width + 1 + place], out=least)
    most = np.zeros(count, np.uint64)
    for place in range(width):
        np.maximum(most[place:place + len(least)], least, out=most[place:place + len(least)])
    chosen = most == hashes  # the run is the least of some window that holds it
    chosen[1:] &= hashes[1:] != hashes[:-1]
    places = np.flatnonzero(chosen)
    return hashes[places], places.astype(np.int32)


def seeds_of(hashes: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, text numbers, places) of the seeds() of many texts, those of at least min_words words; first[i]:first[i + 1]: the words
    of text i."""
    sizes = np.diff(first)
    short = np.flatnonzero((sizes >= min_words) & (sizes < SEED_WORDS + SEED_WINDOW - 1))
    alone = [(*seeds(hashes[first[i]:first[i + 1]]), i) for i in short.tolist()]
    found = [(h, np.full(len(h), i), places) for h, places, i in alone]
    if (sizes >= max(min_words, SEED_WORDS + SEED_WINDOW - 1)).any():
        runs = shingle_hashes(hashes, SEED_WORDS)
        text = np.repeat(np.arange(len(sizes)), sizes)[:len(runs)]
        at = np.arange(len(runs))
        behind = np.where(sizes >= max(min_words, SEED_WORDS + SEED_WINDOW - 1), first[1:], 0)[text]
        count = len(runs) - SEED_WINDOW + 1
        least = runs[:count].copy()
        for place in range(1, SEED_WINDOW):
            np.minimum(least, runs[place:count + place], out=least)
        least[at[:count] + SEED_WORDS + SEED_WINDOW - 1 > behind[:count]] = 0  # runs of two texts
        most = np.zeros(len(runs), np.uint64)
        for place in range(SEED_WINDOW):
            np.maximum(most[place:place + count], least, out=most[place:place + count])
        chosen = (most == runs) & (at + SEED_WORDS <= behind)
        chosen[1:] &= (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])
        chosen = np.flatnonzero(chosen)
        found.append((runs[chosen], text[chosen], (chosen - first[text[chosen]]).astype(np.int32)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    return tuple(np.concatenate(c) for c in zip(*found))


def _seed_rows(docs: DataFrame, min_words: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for first, end, data, offsets in texts_of(batch.column(1)):
                if not len(data):
                    continue
                words = Words(data, offsets)
                hashes, text, places = seeds_of(words.hashes(), words.first, min_words)
                if len(hashes):
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(ids[first:end][text]), pa.array(places)], ["h", "doc", "pos"])

    return map_texts(docs, work, "h long, doc long, pos int")


def _same_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and a hash of the sequence of words, for each row of docs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys = [], []
            for first, end, data, offsets in texts_of(batch.column(1)):
                words = Words(data, offsets) if len(data) else None
                sizes = np.diff(words.first) if words else np.zeros(end - first, np.int64)
                own = words.hashes() if words else np.zeros(0, np.uint64)
                with np.errstate(over="ignore"):
                    places = np.arange(1, len(own) + 1) - np.repeat(words.first[:-1], sizes) if words else np.zeros(0)
                    order = places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    sums = (np.append(np.zeros(1, np.uint64), np.cumsum(h)) for h in (mix(own + order), mix(own ^ mix(order))))
                    edges = words.first if words else np.zeros(end - first + 1, np.int64)
                    both = np.stack([s[edges[1:]] - s[edges[:-1]] for s in sums], axis=1)
                keys += [key.tobytes() for key in both]
                counts += sizes.tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(keys, pa.binary())],
                                             ["doc_id", "n_words", "key"])

    return map_texts(docs, work, "doc_id long, n_words long, key binary")


def _shared(rows: DataFrame) -> DataFrame:
    """rows (h, doc, pos, ...) whose h other documents have too, with the first such document, source. Aggregation finds it and
    a join brings it to the others, so a seed that a third of all rows have is split over tasks like any other. rows are read
    twice; seeds are computed again rather than kept, as they take more disk than their texts."""
    firsts = rows.groupBy("h").agg(F.min("doc").alias("source"), F.max("doc").alias("last")).where("source <> last")
    firsts = materialized(firsts)  # else the aggregation would bind the join to its partitions, which then can't be split
    return materialized(rows.join(firsts.select("h", "source"), "h"))


def _placed(shared: DataFrame) -> DataFrame:
    """Each shared row with its first place in its source, y."""
    places = materialized(shared.where("doc = source").groupBy("h").agg(F.min("pos").alias("y")))  # as firsts in _shared()
    return shared.join(places, "h")


def _to_first(shared: DataFrame) -> DataFrame:
    """Each shared row (at x) of a document other than its source, with its first place there, y."""
    return _placed(shared).where("doc <> source").withColumnRenamed("pos", "x")


def contexts(doc: np.ndarray, pos: np.ndarray, hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the seeds that start them, hashes, numbers of the seeds that end them) of sequences of seeds, sorted
    by doc and pos, that leave no word out and have from half of `words` to all. They start at the least of the runs behind
    and end at the last that is the least of the runs before it, so what stands around them doesn't change the seeds in them.
    The seeds overlap or adjoin, so equal hashes stand for equal words."""
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    places = pos.astype(np.int64)
    stretch = np.concatenate([[0], np.cumsum((doc[1:] != doc[:-1]) | (np.diff(places) > SEED_WORDS))])
    line = stretch * (int(places.max()) + words + 1) + places
    opens, closes = np.ones(len(doc), bool), np.ones(len(doc), bool)
    for ahead in range(1, min(SEED_WINDOW, len(doc))):
        near = line[ahead:] - line[:-ahead] < SEED_WINDOW
        opens[:-ahead] &= ~(near & (hashes[ahead:] < hashes[:-ahead]))
        closes[ahead:] &= ~(near & (hashes[:-ahead] < hashes[ahead:]))
    ends = np.flatnonzero(closes)  # the first seed of a stretch is one
    last = ends[np.searchsorted(line[ends], line + words - SEED_WORDS, "right") - 1]
    reach = line[last] - line
    starts = np.flatnonzero(opens & (2 * (reach + SEED_WORDS) >= words))
    with np.errstate(over="ignore"):
        up, down = (np.power(np.uint64(b), places.astype(np.uint64)) for b in (_STEP, pow(_STEP, -1, 2**64)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
        found = mix((sums[last + 1] - sums[:-1])[starts] * down[starts] + np.uint64(words))
    return starts, found, last[starts]


def open_spans(doc: np.ndarray, pos: np.ndarray, source: np.ndarray, y: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """(doc, start, end) of the spans, in words, in which runs of `words` words may stand that an earlier document has although
    the seeds don't lead there. doc, pos: shared seeds, sorted; source, y: where each stands first. A run has seeds all along, but
    for SEED_WINDOW - 1 words at its ends. If seeds that overlap or adjoin and lead to one place cover it, that is a document
    with the run; the others are left. An end may lie behind the document's."""
    places, to = pos.astype(np.int64), y.astype(np.int64)
    cut = (doc[1:] != doc[:-1]) | (np.diff(places) > SEED_WORDS)
    turn = cut | (source[1:] != source[:-1]) | (np.diff(places) != np.diff(to))
    firsts, lasts = (np.flatnonzero(np.append(True, c)) for c in (cut, turn)), (np.flatnonzero(np.append(c, True)) for c in (cut, turn))
    (stretch, run), (stretch_last, run_last) = firsts, lasts
    begin = np.maximum(places[stretch] - SEED_WINDOW + 1, 0)
    latest = places[stretch_last] + SEED_WORDS + SEED_WINDOW - 1 - words  # the start of the last run of words
    long = places[run_last] + SEED_WORDS - places[run] >= words
    run, run_last = run[long], run_last[long]
    of = np.searchsorted(stretch, run, "right") - 1
    # Starts that are left: before each covering run, from the stretch's begin or the run before; and behind the last.
    owner = np.concatenate([of, np.arange(len(stretch))])
    order = np.argsort(owner, kind="stable")  # a stretch's runs, then its end
    owner = owner[order]
    until = np.concatenate([places[run] - 1, latest])[order]
    behind = np.concatenate([places[run_last] + SEED_WORDS - words + 1, np.zeros(len(stretch), np.int64)])[order]
    since = begin[owner]
    since[1:] = np.where(owner[1:] == owner[:-1], behind[:-1], since[1:])
    left = until >= since
    return doc[stretch][owner[left]], since[left], until[left] + words


def _context_rows(placed: DataFrame, min_words: int) -> DataFrame:
    """h, doc, pos, reach, near of the sequences of shared seeds; those of a document are sorted together. near: the document
    to which the first and the last seed are linked, if it is one. Rows without h are the open_spans() of min_words words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        for batch in batches:
            held = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
            whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last document may go on
            yield from rows(*(h[:whole] for h in held))
            held = [h[whole:] for h in held]
        yield from rows(*held)

    def rows(doc: np.ndarray, pos: np.ndarray, h: np.ndarray, source: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(doc):
            return
        new = np.append(True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1]) | (h[1:] != h[:-1]))  # rows of one text and doc_id
        doc, pos, h, source, y = doc[new], pos[new], h[new], source[new], y[new]
        for words in _CONTEXTS:
            starts, hashes, last = contexts(doc, pos, h.view(np.uint64), words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(doc[starts]), pa.array(pos[starts]), pa.array(pos[last] - pos[starts]),
                 pa.array(source[starts], mask=source[starts] != source[last])], ["h", "doc", "pos", "reach", "near"])
        own, since, until = open_spans(doc, pos, source, y, min_words)
        none = pa.nulls(len(own), pa.int64())
        yield pa.RecordBatch.from_arrays([none, pa.array(own), pa.array(since.astype(np.int32)), pa.array((until - since).astype(np.int32)), none],
                                         ["h", "doc", "pos", "reach", "near"])

    dealt = placed.select("doc", "pos", "h", "source", "y").repartition("doc").sortWithinPartitions("doc", "pos", "h")
    return dealt.mapInArrow(work, "h long, doc long, pos int, reach int, near long")


def _run_rows(docs: DataFrame, spans: DataFrame, min_words: int) -> DataFrame:
    """h, doc, pos of every run of min_words words in the spans (doc, pos, reach) of its document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, end, data, offsets in texts_of(batch.column(1)):
                words = Words(data, offsets)
                hashes, found = words.hashes(), []
                for i in range(end - first):
                    own = hashes[words.first[i]:words.first[i + 1]]
                    for span in wanted[first + i]:
                        runs = shingle_hashes(own[span["pos"]:span["pos"] + span["reach"]], min_words)
                        places = np.arange(span["pos"], span["pos"] + len(runs), dtype=np.int32)
                        found.append((runs.view(np.int64), np.full(len(runs), ids[first + i]), places))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["h", "doc", "pos"])

    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("pos", "reach")).alias("spans"))
    own = docs.select(F.col("doc_id").alias("doc"), "text")
    return map_texts(own.join(spans, "doc"), work, "h long, doc long, pos int", ("doc", "text", "spans"))


def _fewest(runs: DataFrame, words: int) -> DataFrame:
    """Of each document's linked runs of `words` words as many as cover the words of all: a document of a group of near copies
    would else be linked with a different one of them at every word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            doc = held.column(0).to_numpy()
            whole = int(np.searchsorted(doc, doc[-1])) if len(doc) else 0  # the last document may go on
            yield from chosen(held.slice(0, whole), doc[:whole])
            held = held.slice(whole)
        if held is not None:
            yield from chosen(held, held.column(0).to_numpy())

    def chosen(rows: pa.Table, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges, x = [*np.flatnonzero(np.append(True, doc[1:] != doc[:-1])).tolist(), len(doc)] if len(doc) else [], rows.column(2).to_numpy()
        keep = np.zeros(len(doc), bool)
        for start, stop in zip(edges, edges[1:]):
            own = x[start:stop]
            if (own[1:] == own[:-1]).any():  # rows of several texts
                keep[start:stop] = True
                continue
            at = 0
            while at < len(own):
                keep[start + at] = True
                at = max(at + 1, int(np.searchsorted(own, own[at] + words, "right")) - 1)
        yield from rows.filter(pa.array(keep)).combine_chunks().to_batches()

    dealt = runs.select("doc", "source", "x", "y").repartition("doc").sortWithinPartitions("doc", "x")
    return dealt.mapInArrow(work, "doc long, source long, x int, y int")


def _links(rows: DataFrame, docs: DataFrame, copies: DataFrame, min_words: int) -> DataFrame:
    """doc, source, x, y, longer: each seed of a document (at x) that an earlier document has too, with the first such document
    and its first place there; the first and last seed of each context (longer = 1) with the first document that has it, if
    it isn't the one to which both seeds are linked anyway; the ends of runs of min_words words that seeds leave open, in the same
    way, and as many of them as cover the words of all. Copies link to nothing."""
    placed = materialized(_placed(_shared(rows)).join(copies, (F.col("doc") == F.col("doc_id")) & (F.col("doc") != F.col("source")), "left_anti"))
    longer = materialized(_context_rows(placed, min_words))
    spans, sequences = longer.where("h is null"), longer.where("h is not null")
    runs = materialized(_run_rows(docs, spans, min_words))
    ends = _to_first(_shared(sequences).where("doc = source or near is null or near <> source")).select(
        "doc", "source", F.explode(F.array(F.lit(0), "reach")).alias("on"), "x", "y")
    whole = _fewest(_to_first(_shared(runs)), min_words).select("doc", "source", F.explode(F.array(F.lit(0), F.lit(min_words - SEED_WORDS))).alias("on"), "x", "y")
    return placed.where("doc <> source").select("doc", "source", F.col("pos").alias("x"), "y", F.lit(0).alias("longer")).union(
        ends.union(whole).select("doc", "source", F.col("x") + F.col("on"), F.col("y") + F.col("on"), F.lit(1)))


def chain(x: list[int], y: list[int]) -> list[list[int]]:
    """Chains of seeds at places x in one text and y in the other, sorted by x, then y: numbers of seeds with both places
    increasing. A chain's score is the words it covers less the cost of its gaps; the best predecessor of a seed is the best
    prefix maximum over y, kept in a Fenwick tree. The best chain is taken first, others from the seeds that remain."""
    count = len(x)
    ranks = {v: i + 1 for i, v in enumerate(sorted(set(y)))}
    size = len(ranks)
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (size + 1)
    score, before = [0.0] * count, [-1] * count
    i = 0
    while i < count:
        j = i
        while j < count and x[j] == x[i]:  # seeds at one place don't follow each other
            j += 1
        for k in range(i, j):
            best, at = (-1e18, -1), ranks[y[k]] - 1
            while at:
                best = max(best, tree[at])
                at &= at - 1
            joined = best[0] - _GAP_COST * (x[k] + y[k] - 2 * SEED_WORDS)
            if joined > 0:
                score[k], before[k] = SEED_WORDS + joined, best[1]
            else:
                score[k] = float(SEED_WORDS)
        for k in range(i, j):
            value, at = (score[k] + _GAP_COST * (x[k] + y[k]), k), ranks[y[k]]
            while at <= size:
                if value > tree[at]:
                    tree[at] = value
                at += at & -at
        i = j
    used, chains = [False] * count, []
    for k in sorted(range(count), key=lambda k: (-score[k], k)):
        own = []
        while k >= 0 and not used[k]:
            used[k] = True
            own.append(k)
            k = before[k]
        if len(own) > 1:
            chains.append(own[::-1])
    return chains


def thinned(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links sorted by x, then y, each once, of stretches that are equal word for word only both ends and one in every _THINNED
    words: align() compares what lies between."""
    if len(x) < 2:
        return x, y
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    x, y = x[new], y[new]
    step = np.diff(x)
    follows = np.concatenate([[False], (step == np.diff(y)) & (step <= SEED_WORDS)])
    keep = ~follows | ~np.append(follows[1:], False)
    keep[1:] |= x[1:] // _THINNED != x[:-1] // _THINNED
    return x[keep], y[keep]


def _chain_rows(links: DataFrame) -> DataFrame:
    """One row for each chain of two or more seeds: doc, source, the seeds' places in them, and whether only contexts link the
    two documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, source, x, y, longer in _groups(batches):
            x, y = (p.tolist() for p in thinned(x, y))
            for own in chain(x, y) if len(x) > 1 else ():
                yield doc, source, [x[k] for k in own], [y[k] for k in own], np.count_nonzero(longer == 0) < 2

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for row in work(batches):
            rows.append(row)
            held += 10 + len(row[2])
            if held > 50_000:  # seeds: a bound on memory, as chains may be long
                yield _chain_batch(rows)
                rows, held = [], 0
        yield _chain_batch(rows)

    dealt = links.repartition("doc").sortWithinPartitions("doc", "source", "x", "y")
    return dealt.select("doc", "source", "x", "y", "longer").mapInArrow(
        batched, "doc long, source long, xs array<int>, ys array<int>, longer boolean")


def _chain_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "source", "xs", "ys", "longer"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of one (doc, source), which may span batches; at most as many as a document has seeds."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if held is not None:
            columns = [np.concatenate(p) for p in zip(held, columns)]
        doc, source = columns[:2]
        edges = np.flatnonzero((doc[1:] != doc[:-1]) | (source[1:] != source[:-1])) + 1
        start = 0
        for stop in edges.tolist():
            yield int(doc[start]), int(source[start]), *(c[start:stop] for c in columns[2:])
            start = stop
        held = [c[start:] for c in columns]
    if held is not None and len(held[0]):
        yield int(held[0][0]), int(held[1][0]), *held[2:]


def _agreeing(a: list[int], b: list[int]) -> int:
    """The longest common subsequence."""
    masks: dict[int, int] = {}
    for place, word in enumerate(a):
        masks[word] = masks.get(word, 0) | 1 << place
    return longest_common_subsequence(masks, len(a), b) if a and b else 0


_AT_ONCE = 512  # pairs of stretches that grow together


def _grown(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(words of a, words of b, agreeing words) by which a passage grows into a and b from their beginnings: the best score of
    an alignment that starts there, one for an equal word, minus one for a changed or missing one."""
    return _all_grown([(a, b)])[0]


def _all_grown(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    """_grown() of many pairs: a row of all their alignments at a time."""
    found: list[tuple[int, int, int]] = []
    for start in range(0, len(pairs), _AT_ONCE):
        found += _grown_together(pairs[start:start + _AT_ONCE])
    return found


def _side_by_side(texts: list[np.ndarray], width: int, none: int) -> np.ndarray:
    """A column for each text, `none` behind its end."""
    sizes = np.array([len(t) for t in texts])
    columns = np.full((len(texts), width), none, np.int64)
    columns[np.arange(width) < sizes[:, None]] = np.concatenate(texts)
    return columns.T


def _grown_together(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    width = max(max(len(a), len(b)) for a, b in pairs)
    one, two = _side_by_side([a for a, _ in pairs], width + 1, -1), _side_by_side([b for _, b in pairs], width + 1, -2)
    equal = (one != two).argmax(axis=0)  # the last row differs
    rest = [(a[n:], b[n:]) for (a, b), n in zip(pairs, equal.tolist())]
    grown = np.zeros((3, len(pairs)), np.int64)
    own = np.array([i for i, (a, b) in enumerate(rest) if len(a) and len(b)], np.int64)
    if len(own):
        a, b = (_side_by_side([rest[i][side] for i in own], width, none) for side, none in ((0, -1), (1, -2)))
        # A word of a that b has adds one to a row's best score at most, any other takes one off: by how much it can still rise.
        known = np.zeros(a.shape, bool)
        for word in b:
            known |= a == word
        gains = np.cumsum(np.where(known, 1, -1), axis=0)
        highest = np.maximum.accumulate(gains[::-1], axis=0)[::-1]
        steps = np.arange(width + 1)[:, None]
        row, agree = np.repeat(-steps, len(own), axis=1), np.zeros((width + 1, len(own)), np.int64)
        best = np.zeros(len(own), np.int64)
        for i in range(width):
            left = row.max(axis=0) + highest[i] - (gains[i - 1] if i else 0) > best
            if not left.any():
                break
            if np.count_nonzero(left) < 0.8 * len(left):
                own, best, a, b, row, agree, gains, highest = (t[..., left] for t in (own, best, a, b, row, agree, gains, highest))
            hit = b == a[i]
            above, diagonal = row - 1, np.full(row.shape, -10**6)
            diagonal[1:] = row[:-1] + np.where(hit, 1, -1)
            counts = agree.copy()
            np.copyto(counts[1:], agree[:-1] + hit, where=diagonal[1:] >= above[1:])
            # The last of the best places before, with its words that agree, in one number of three parts.
            packed = np.maximum.accumulate(((np.maximum(above, diagonal) + steps) << 40) + (steps << 20) + counts, axis=0)
            row, agree = (packed >> 40) - steps, packed & 0xFFFFF
            top = row.max(axis=0)
            better = np.flatnonzero(top > best)
            if len(better):
                place = row[:, better].argmax(axis=0)
                best[better] = top[better]
                grown[:, own[better]] = np.stack([np.full(len(better), i + 1), place, agree[place, better]])
    return [tuple(g) for g in (grown + equal).T.tolist()]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Words of a that b has: no alignment of the two has more that agree."""
    others = set(b.tolist())
    return sum(word in others for word in a.tolist())


def align(xs: list[int], ys: list[int], a: np.ndarray, a_start: int, b: np.ndarray, b_start: int,
          least: float = 0) -> Iterator[tuple[int, int, int, int, int, tuple, tuple]]:
    """(start, end, start, end, agreeing words, before, behind) of the passages of a chain, in words, before they grow; before and
    behind: the pairs of stretches into which _grown() lets them grow, the one before backwards. a and b: the word hashes from a_start and
    b_start on, around the chain. Passages in which fewer than `least` words can agree are left out."""
    pieces, agreeing, first, last = [], SEED_WORDS, 0, 0
    for k in range(1, len(xs)):
        step_x, step_y = xs[k] - xs[last], ys[k] - ys[last]
        if step_x == step_y and step_x <= SEED_WORDS:
            agreeing += step_x
        elif min(step_x, step_y) < SEED_WORDS:  # overlaps in one text only: the last seed stays
            continue
        else:
            x, y = xs[last] + SEED_WORDS, ys[last] + SEED_WORDS
            gap_a, gap_b = a[x - a_start:xs[k] - a_start].tolist(), b[y - b_start:ys[k] - b_start].tolist()
            common = len(gap_a) if gap_a == gap_b else _agreeing(gap_a, gap_b)
            if max(len(gap_a), len(gap_b)) > _WIDEST_GAP and 2 * common < max(len(gap_a), len(gap_b)):
                pieces.append((first, last, agreeing))
                first, agreeing = k, SEED_WORDS
            else:
                agreeing += common + SEED_WORDS
        last = k
    pieces.append((first, last, agreeing))
    for first, last, agreeing in pieces:
        start_x, start_y = xs[first] - a_start, ys[first] - b_start
        end_x, end_y = xs[last] + SEED_WORDS - a_start, ys[last] + SEED_WORDS - b_start
        before = a[max(0, start_x - _AROUND):start_x][::-1], b[max(0, start_y - _AROUND):start_y][::-1]
        behind = a[end_x:end_x + _AROUND], b[end_y:end_y + _AROUND]
        if agreeing + _common(*before) + _common(*behind) < least:
            continue
        if least and agreeing + sum(_agreeing(one.tolist(), two.tolist()) for one, two in (before, behind)) < least:
            continue
        yield start_x + a_start, end_x + a_start, start_y + b_start, end_y + b_start, agreeing, before, behind


def _passages(pieces: list[tuple]) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, start, end, agreeing words) of what align() gives, grown."""
    left, right = (_all_grown([p[side] for p in pieces]) for side in (5, 6))
    for (start, end, from_, to, agreeing, *_), before, behind in zip(pieces, left, right):
        yield start - before[0], end + behind[0], from_ - before[1], to + behind[1], agreeing + before[2] + behind[2]


def _slices(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, lo, hi and the word hashes (32 bits each) lo:hi of each wanted slice."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for first, end, data, offsets in texts_of(batch.column(1)):
                words = Words(data, offsets)
                hashes = (words.hashes() >> np.uint64(32)).astype(np.uint32)
                rows = []
                for i in range(end - first):
                    own = hashes[words.first[i]:words.first[i + 1]]
                    rows += [(ids[first + i], s["lo"], s["hi"], own[s["lo"]:s["hi"]].tobytes()) for s in spans[first + i]]
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc", "lo", "hi", "words"])

    spans = wanted.distinct().groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    own = docs.select(F.col("doc_id").alias("doc"), "text")
    return map_texts(own.join(spans, "doc"), work, "doc long, lo int, hi int, words binary", ("doc", "text", "spans"))


def _without_repeats(found: DataFrame) -> DataFrame:
    """Without passages that only contexts link to their source and that add fewer words than a seed has to the document's
    passages with sources linked by seeds, or with earlier ones."""
    names = [c for c in found.columns if c != "longer"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, covered = None, []
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "longer", "start_word", "end_word"))
            for own, longer, start, end in zip(*columns):
                if own != doc:
                    doc, covered = own, []
                left, at = 0, start
                for begin, stop in covered if longer else ():
                    left, at = left + max(0, min(begin, end) - at), max(at, stop)
                keep.append(not longer or left + max(0, end - at) >= SEED_WORDS)
                if keep[-1]:
                    insort(covered, (start, end))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    dealt = found.repartition("doc_id").sortWithinPartitions("doc_id", "longer", "source_doc_id", "start_word", "end_word")
    return dealt.mapInArrow(work, found.drop("longer").schema)


def repeated_passages(docs: DataFrame, min_words: int = 45, min_similarity: float = 0.75) -> DataFrame:
    """doc_id, source_doc_id, kind, start_word, end_word, source_start, source_end, n_words, similarity.

    kind `copy`: the document has the words of source_doc_id, the least doc_id that has them; it has no other rows. kind
    `passage`: its words start_word:end_word are, with at most 1 - min_similarity of them changed, words of
    source_doc_id, one of the first documents that have parts of the passage, up to 36 words of it in a row, or min_words words in a row
    where the seeds don't lead to one place: all words of a run of min_words words that an earlier document has stand in some passage, unless
    one word fills nine places of the run. Passages have min_words words or more on both sides. Repeats within a document are not reported. Rows with a null doc_id or text and shorter texts match
    nothing; of rows that share a doc_id, each counts as text of that document. Only doc_id and text are read.
    """
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    texts = materialized(_same_texts(docs).where(F.col("n_words") >= min_words))
    classes = texts.groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    classes = materialized(classes.where("rep <> last"))
    copies = materialized(texts.join(classes, "key").where("doc_id <> rep").select("doc_id", "rep", "n_words").distinct())

    gone = copies.select("doc_id").distinct()
    links = _links(_seed_rows(docs, min_words), docs, gone, min_words)
    links = links.join(gone.withColumnRenamed("doc_id", "doc"), "doc", "left_anti")
    chains = _chain_rows(links)
    low = lambda c: (F.floor(F.greatest(F.array_min(c) - _AROUND, F.lit(0)) / _GRID) * _GRID).cast("int")
    high = lambda c: (F.ceil((F.array_max(c) + SEED_WORDS + _AROUND) / _GRID) * _GRID).cast("int")
    chains = materialized(chains.select("*", low("xs").alias("x_lo"), high("xs").alias("x_hi"), low("ys").alias("y_lo"),
                                        high("ys").alias("y_hi")))
    wanted = chains.select("doc", F.col("x_lo").alias("lo"), F.col("x_hi").alias("hi")).union(
        chains.select(F.col("source").alias("doc"), F.col("y_lo").alias("lo"), F.col("y_hi").alias("hi")))
    slices = materialized(_slices(docs, wanted))
    side = lambda doc, lo, hi, words: slices.select(
        F.col("doc").alias(doc), F.col("lo").alias(lo), F.col("hi").alias(hi), F.col("words").alias(words))
    both = (chains.join(side("doc", "x_lo", "x_hi", "a"), ["doc", "x_lo", "x_hi"])
            .join(side("source", "y_lo", "y_hi", "b"), ["source", "y_lo", "y_hi"]))
    schema = ("doc_id long, source_doc_id long, kind string, start_word long, end_word long, source_start long, "
              "source_end long, n_words long, similarity double, longer boolean")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            pieces, of = [], []
            for doc, source, xs, ys, x_lo, y_lo, a, b, longer in zip(*(batch.column(i).to_pylist() for i in range(9))):
                a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                pieces += align(xs, ys, a, x_lo, b, y_lo, min_similarity * min_words - 1e-9)
                of += [(doc, source, longer)] * (len(pieces) - len(of))
            for (doc, source, longer), (start, end, from_, to, agreeing) in zip(of, _passages(pieces)):
                most = max(end - start, to - from_)
                if min(end - start, to - from_) >= min_words and agreeing >= min_similarity * most:
                    rows.append((doc, source, "passage", start, end, from_, to, end - start, agreeing / most, longer))
            columns = list(zip(*rows)) if rows else [()] * 10
            kinds = [pa.int64()] * 2 + [pa.string()] + [pa.int64()] * 5 + [pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [f.split()[0] for f in schema.split(", ")])

    found = both.select("doc", "source", "xs", "ys", "x_lo", "y_lo", "a", "b", "longer").mapInArrow(work, schema)
    whole = copies.select("doc_id", F.col("rep").alias("source_doc_id"), F.lit("copy").alias("kind"), F.lit(0).cast("long"), "n_words",
                          F.lit(0).cast("long"), "n_words", "n_words", F.lit(1.0))
    return _without_repeats(found).union(whole)
