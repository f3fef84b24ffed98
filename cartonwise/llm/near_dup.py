"""Near-duplicate documents by a chosen-path set similarity join.

Every tree sends a document down the path of its own minwise shingles: a node's documents are branched by coordinates of their
MinHash signatures that tree and level select, and documents that agree there meet again in a child. Small nodes are compared
exhaustively, larger ones branched on; independent trees raise the recall. Documents that look similar there are tied to
clusters, and within a cluster all documents are compared on their full shingle sets.

Only connections matter. So the first levels of a few trees, where large nodes are compared with a few pivots only, tie most
of each cluster together; in the full search, nodes within one cluster are done, and those with few documents outside their
largest one compare just these with the others. Likewise a large cluster's documents that confirmed links have joined are
not compared with each other again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.components import components
from cartonwise.llm.tables import discard, map_texts, released
from cartonwise.llm.text_arrays import Words, mix, shingle_hashes, texts_of

WIDTH = 5  # words in a shingle
SIGNATURE = 64  # coordinates by which trees branch, four bytes each
PROFILE = 256  # coordinates from which a similarity is estimated, one byte each
TREES = 16
_FIRST_TREES = 4
_LEAF = 256  # documents of a node that are compared exhaustively
_SIDE = 512  # documents of a large cluster that are compared at once with the others of a node
_PIVOTS = 2
_BRANCHES = 2  # coordinates by which a larger node is branched
_DEPTH = 12  # levels at most; larger nodes that are left are compared exhaustively, in blocks
_COMPARISONS = 1024  # for each document; branching ends when the nodes that are left take no more
_ACTIVE = 4  # trees in which a document must meet another one; a pair at 0.75 misses that 4 times in a million
_LOOKS_SIMILAR = 0.65  # of the profile; a pair at 0.75 stays below it once in 10,000
_BLOCK = 256  # documents of a cluster in a block
_MEETING = 1024  # documents of a large cluster in two blocks that meet: its texts travel once for every other block
_COLUMNS = 4096  # shingles that are compared at once


@cache
def _factors(count: int) -> np.ndarray:
    return np.random.default_rng(count).integers(1, 2**63, count, dtype=np.uint64) | np.uint64(1)


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of all runs of WIDTH words; of the whole sequence if it is shorter; none without words."""
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(shingle_hashes(words, min(WIDTH, len(words))))


def text_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text, A-Z read as a-z."""
    for first, end, data, offsets in texts_of(column):
        if not len(data):
            yield from (np.zeros(0, np.uint64) for _ in range(first, end))
            continue
        words = Words(data, offsets)
        hashes = words.hashes()
        for i in range(end - first):
            yield shingle_set(hashes[words.first[i]:words.first[i + 1]])


def least_hashes(shingles: np.ndarray, count: int) -> np.ndarray:
    """For each of count permutations the least hash, mixed."""
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 256):
            np.minimum(least, (shingles[at:at + 256, None] * _factors(count)).min(0), out=least)
    return mix(least)


def signature(shingles: np.ndarray) -> bytes:
    return (least_hashes(shingles, SIGNATURE) >> np.uint64(32)).astype(np.uint32).tobytes()


def profile(shingles: np.ndarray) -> bytes:
    return (least_hashes(shingles, PROFILE) >> np.uint64(56)).astype(np.uint8).tobytes()


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_hash (equal for equal sets; null for the empty set), signature, for each row of docs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes, signatures = [], [], []
            for shingles in text_sets(batch.column(1)):
                sizes.append(len(shingles))
                if len(shingles):
                    with np.errstate(over="ignore"):
                        sums = np.array([mix(shingles).sum(), mix(shingles ^ np.uint64(0x5BD1E995)).sum()], np.uint64)
                    hashes.append(sums.tobytes())
                    signatures.append(signature(shingles))
                else:
                    hashes.append(None)
                    signatures.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()),
                 pa.array(signatures, pa.binary())], ["doc_id", "n_shingles", "set_hash", "signature"])

    return map_texts(docs, work, "doc_id long, n_shingles long, set_hash binary, signature binary")


def _profiles(texts: DataFrame) -> DataFrame:
    """doc and profile of each row (doc, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profile(shingles) for shingles in text_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc", "profile"])

    return texts.select("doc", "text").mapInArrow(work, "doc long, profile binary")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarities: equal bytes, less those equal by chance."""
    return ((a == b).mean(-1) - 1 / 256) * (256 / 255)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PROFILE)


@cache
def _coordinates(tree: int) -> list[int]:
    """The order in which a tree uses the coordinates; the first ones of all trees differ."""
    rest = [c for c in range(SIGNATURE) if c != tree]
    return [tree, *np.random.default_rng(tree).permutation(rest).tolist()]


def _value(level: int, branch: int, trees: range) -> Column:
    """The bytes of the coordinate that the row's tree uses at a level and branch."""
    place = 0 if level == 0 else 1 + _BRANCHES * (level - 1) + branch
    starts = F.lit([4 * _coordinates(t)[place % SIGNATURE] + 1 for t in trees])
    return F.col("signature").substr(F.element_at(starts, F.col("tree") - trees.start + 1), F.lit(4))


def _roots(active: DataFrame, trees: range) -> DataFrame:
    """(tree, node, doc) of the first level: documents that agree in the tree's first coordinate."""
    rows = active.withColumn("tree", F.explode(F.lit(list(trees))))
    return rows.select("tree", F.xxhash64("tree", _value(0, 0, trees)).alias("node"), "doc")


def _runs(batches: Iterator[pa.RecordBatch], convert: Callable[[pa.RecordBatch], list[np.ndarray]]) -> Iterator[list[list[np.ndarray]]]:
    """For each batch the columns of all runs of equal first values that have ended; runs may span batches."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = convert(batch)
        if held is not None:
            columns = [np.concatenate(p) for p in zip(held, columns)]
        starts = [0, *(np.flatnonzero(columns[0][1:] != columns[0][:-1]) + 1).tolist()]
        yield [[c[s:e] for c in columns] for s, e in zip(starts, starts[1:])]
        held = [c[starts[-1]:] for c in columns]
    if held is not None:
        yield [held]


class _Forest:
    """Which labels are joined."""

    def __init__(self) -> None:
        self.root: dict[int, int] = {}

    def join(self, one: int, two: int) -> bool:
        """Whether they were apart."""
        ends = []
        for label in (one, two):
            while (up := self.root.get(label, label)) != label:
                self.root[label] = label = self.root.get(up, up)
            ends.append(label)
        self.root[ends[0]] = ends[1]
        return ends[0] != ends[1]


def _pair_batch(pairs: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    both = np.concatenate([np.zeros((0, 2), np.int64), *pairs])
    return pa.RecordBatch.from_arrays([pa.array(both.min(1, initial=2**63 - 1)), pa.array(both.max(1, initial=-2**63))], names)


def _leaf_pairs(rows: DataFrame) -> DataFrame:
    """(a, b) of documents of one node that look similar and are in different clusters, only as many as connect them: at most
    one pair fewer than the node has documents. rows (node, doc, comp, profile) has a bounded number for each node."""

    def compare(docs: np.ndarray, comps: np.ndarray, profiles: np.ndarray) -> np.ndarray:
        left, right = np.nonzero(np.triu(comps[:, None] != comps, 1))
        likeness = np.concatenate([_alike(profiles[left[i:i + 4096]], profiles[right[i:i + 4096]])
                                   for i in range(0, len(left), 4096)] or [np.zeros(0)])
        near, forest = np.flatnonzero(likeness >= _LOOKS_SIMILAR), _Forest()
        chosen = [i for i in near[np.argsort(-likeness[near], kind="stable")].tolist()
                  if forest.join(int(comps[left[i]]), int(comps[right[i]]))]
        return np.stack([docs[left[chosen]], docs[right[chosen]]], 1) if chosen else np.zeros((0, 2), np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes in _runs(batches, lambda b: [*(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)), _matrix(b.column(3))]):
            yield _pair_batch([compare(*columns) for _, *columns in nodes if len(columns[0]) > 1], ["a", "b"])

    return (rows.select("node", "doc", "comp", "profile").repartition("node").sortWithinPartitions("node")
            .mapInArrow(work, "a long, b long").distinct())


def _first_pairs(active: DataFrame) -> DataFrame:
    """Pairs from the first level of a few trees: small nodes' most similar ones, larger nodes' documents and pivots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array(_alike(_matrix(batch.column(2)), _matrix(batch.column(3))) >= _LOOKS_SIMILAR)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    rows = materialized(_roots(active, range(_FIRST_TREES)).withColumn("comp", F.col("doc")))
    sizes = materialized(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"))
    profiles = active.select("doc", "profile")
    small = rows.join(sizes.where(F.col("n") <= _LEAF), "node", "left_semi").join(profiles, "doc")
    large = rows.join(sizes.where(F.col("n") > _LEAF), "node").withColumn("lot", F.xxhash64("doc", "node"))
    # The pivots are the least of a pseudo-random order in each of _PIVOTS parts of a node.
    part = F.pmod(F.xxhash64("node", "doc"), F.lit(_PIVOTS))
    pivots = large.groupBy("node", part.alias("part")).agg(F.min(F.struct("lot", "doc")).alias("p")).select(
        "node", F.col("p.doc").alias("pivot"))
    both = (large.join(pivots, "node").where("doc <> pivot").join(profiles, "doc")
            .join(profiles.select(F.col("doc").alias("pivot"), F.col("profile").alias("pivot_profile")), "pivot"))
    stars = both.select(F.least("doc", "pivot").alias("a"), F.greatest("doc", "pivot").alias("b"), "profile", "pivot_profile")
    return _leaf_pairs(small).union(stars.mapInArrow(work, "a long, b long")).distinct()


def _one_sided(rows: DataFrame, sided: DataFrame) -> DataFrame:
    """Nodes with few documents outside their largest component: that component in parts, each with all the others."""
    placed = rows.join(sided.select("node", "major", F.ceil(F.col("n") / _SIDE).cast("int").alias("parts")), "node")
    own = F.array(F.pmod(F.xxhash64("doc", F.lit("side")), F.col("parts")).cast("int"))
    parts = F.when(F.col("comp") == F.col("major"), own).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    return placed.withColumn("part", F.explode(parts)).select(F.xxhash64("node", "part").alias("node"), "doc", "comp")


def _blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Nodes that are compared exhaustively, as nodes of two blocks of documents each: every two documents meet."""
    count = F.ceil(F.col("n") / (_SIDE // 2)).cast("int")
    placed = rows.join(sizes.select("node", count.alias("blocks")), "node").withColumn(
        "block", F.pmod(F.xxhash64("doc", F.lit("block")), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select(F.xxhash64("node", F.least("block", "other"), F.greatest("block", "other")).alias("node"), "doc", "comp")


def _walk(active: DataFrame, comps: DataFrame, trees: range) -> DataFrame:
    """Pairs (a, b) of all trees between documents of different clusters."""
    labelled = comps.select(F.col("vertex").alias("doc"), F.col("component").alias("comp"))
    rows = _roots(active, trees).join(labelled, "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    pairs, affordable = None, _COMPARISONS * active.count()
    for level in range(_DEPTH):
        rows = materialized(rows)
        sizes = rows.groupBy("node", "comp").agg(F.count("*").alias("c")).groupBy("node").agg(
            F.sum("c").alias("n"), F.max(F.struct("c", "comp")).alias("m"))
        sizes = materialized(sizes.where("n > m.c").select("node", "n", F.col("m.comp").alias("major"), (F.col("n") - F.col("m.c")).alias("others")))
        small = rows.join(sizes.where(F.col("n") <= _LEAF), "node", "left_semi").select("node", "doc", "comp")
        sided = sizes.where((F.col("n") > _LEAF) & (F.col("others") <= _LEAF))
        large = sizes.where((F.col("n") > _LEAF) & (F.col("others") > _LEAF))
        compared = small.union(_one_sided(rows, sided))
        work = large.agg(F.sum(F.col("n").cast("double") * F.col("n") / 2)).first()[0] or 0.0
        last = level == _DEPTH - 1 or work <= affordable
        if last and work:
            compared = compared.union(_blocks(rows, large))
        # Written level by level: one plan of all levels would take the driver's memory.
        found = materialized(_leaf_pairs(compared.join(active.select("doc", "profile"), "doc")))
        pairs = found if pairs is None else pairs.union(found)
        if last:
            break
        held = rows.join(large, "node", "left_semi").join(active.select("doc", "signature"), "doc")
        children = [F.struct(F.lit(b).alias("branch"), _value(level + 1, b, trees).alias("value")) for b in range(_BRANCHES)]
        rows = held.select("tree", "node", "doc", "comp", F.inline(F.array(*children))).select(
            "tree", F.xxhash64("node", "branch", "value").alias("node"), "doc", "comp")
    return pairs.distinct()


def _similar(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """(i, j), i < j, of the sets with 100 * intersection >= percent * union. Intersections are products of 0/1 rows over the
    sets' shingles, some columns at a time."""
    tokens, places = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(places, kind="stable")
    places, owner = places[order], owner[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, len(tokens), _COLUMNS):
        low, high = np.searchsorted(places, (start, start + _COLUMNS))
        rows = np.zeros((len(sets), min(_COLUMNS, len(tokens) - start)), np.float32)
        rows[owner[low:high], places[low:high] - start] = 1
        common += rows @ rows.T
    sizes = np.array([len(s) for s in sets])
    union = sizes[:, None] + sizes - common
    return np.argwhere(np.triu(100 * common.astype(np.float64) >= percent * union.astype(np.float64), 1))


def _exact(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between documents of one block that are in different components, as many as connect them. rows (block, doc,
    comp, text) has a bounded number for each block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def convert(batch):
            sets = np.empty(batch.num_rows, object)
            for i, shingles in enumerate(text_sets(batch.column(3))):
                sets[i] = shingles
            return [*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)), sets]

        for blocks in _runs(batches, convert):
            pairs = []
            for _, docs, comps, sets in blocks:
                forest = _Forest()
                links = [(i, j) for i, j in _similar(list(sets), percent).tolist() if forest.join(int(comps[i]), int(comps[j]))]
                pairs.append(docs[np.array(links, np.int64).reshape(-1, 2)])
            yield _pair_batch(pairs, ["u", "v"])

    return (rows.select("block", "doc", "comp", "text").repartition("block").sortWithinPartitions("block")
            .mapInArrow(work, "u long, v long").distinct())


def _links(clusters: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(u, v) that connect what is linked within each cluster (vertex, component).

    A cluster of up to _BLOCK documents is one block. Documents of a larger one are dealt to blocks twice, and what meets in a
    block is linked; then every two blocks that hold more than one component meet, blocks being filled component by
    component."""
    members = clusters.select(F.col("vertex").alias("doc"), F.col("component").alias("cluster"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"))
    members = materialized(members.join(sizes, "cluster").withColumn("comp", F.col("doc")))
    small = members.where(F.col("n") <= _BLOCK).select(F.col("cluster").alias("block"), "doc", "comp")
    links = materialized(_exact(small.join(texts, "doc"), percent))
    large = members.where(F.col("n") > _BLOCK)
    if large.isEmpty():
        return links
    count = F.ceil(F.col("n") / _BLOCK)
    dealt = [large.select(F.xxhash64("cluster", F.pmod(F.xxhash64("doc", F.lit(deal)), count), F.lit(deal)).alias("block"), "doc", "comp")
             for deal in (1, 2)]
    first = components(_exact(dealt[0].union(dealt[1]).join(texts, "doc"), percent))
    joined = first.select(F.col("vertex").alias("doc"), F.col("component").alias("joined"))
    large = large.join(joined, "doc", "left").withColumn("comp", F.coalesce("joined", "doc"))
    sizes = large.groupBy("cluster", "comp").agg(F.count("*").alias("c"))
    # Blocks of one large component, and blocks of the documents that are in small ones.
    own = F.when(F.col("c") > _BLOCK, F.col("comp"))
    large = large.join(sizes, ["cluster", "comp"]).withColumn("own", own)
    totals = large.groupBy("cluster", "own").agg(F.count("*").alias("total")).withColumnRenamed("own", "_own")
    placed = large.join(totals.withColumnRenamed("cluster", "_cluster"), (F.col("cluster") == F.col("_cluster")) & F.col("own").eqNullSafe(F.col("_own")))
    placed = materialized(placed.select("cluster", "doc", "comp", "own", F.pmod(F.xxhash64("doc"), F.ceil(F.col("total") / (_MEETING // 2))).alias("number")))
    blocks = placed.select("cluster", "own", "number").distinct()
    left = blocks.select("cluster", F.col("own").alias("own_1"), F.col("number").alias("number_1"))
    right = blocks.select("cluster", F.col("own").alias("own_2"), F.col("number").alias("number_2"))
    met = left.join(right, "cluster").where(  # pairs of blocks, not of documents; those within one component are left out
        (F.struct("own_1", "number_1") <= F.struct("own_2", "number_2")) & ~F.coalesce(F.col("own_1") == F.col("own_2"), F.lit(False)))
    met = met.withColumn("block", F.xxhash64("cluster", "own_1", "number_1", "own_2", "number_2"))
    sides = met.select("cluster", F.col("own_1").alias("own"), F.col("number_1").alias("number"), "block").union(
        met.select("cluster", "own_2", "number_2", "block")).distinct()
    sides = sides.select(F.col("cluster").alias("c"), F.col("own").alias("o"), F.col("number").alias("k"), "block")
    rows = placed.join(sides, (F.col("cluster") == F.col("c")) & F.col("own").eqNullSafe(F.col("o")) & (F.col("number") == F.col("k")))
    stars = first.where("vertex <> component").select(F.col("vertex").alias("u"), F.col("component").alias("v"))
    return links.union(stars).union(_exact(rows.select("block", "doc", "comp").join(texts, "doc"), percent))


def link(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs. Documents are linked if 100 * intersection >= percent *
    union holds for their shingle sets; component_id is the least doc_id reached over links, kept says that it is the
    document's own.

    Documents with equal sets are one class from the start, and its least doc_id stands for it. Documents without words are
    linked with nothing. Rows with one doc_id are one document, each with its own set. A null doc_id has component_id null
    and is kept, unlinked. Only doc_id and text are read.
    """
    with released(docs.sparkSession):
        sketched, classes, comps = _components_of(docs, percent)
    found = sketched.join(classes, "set_hash", "left").join(comps, F.col("rep") == F.col("vertex"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _components_of(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketches of all rows, the document that stands for each set, components of these documents), as tables."""
    sketched = materialized(sketches(docs))
    known = sketched.where("doc_id is not null and set_hash is not null")
    classes = materialized(known.groupBy("set_hash").agg(F.min("doc_id").alias("rep")))
    reps = known.join(classes, "set_hash").where("doc_id = rep").select(F.col("doc_id").alias("doc"), "signature").distinct()

    # Documents that meet others in enough trees: the others cannot be linked, and need neither text nor comparison.
    met = _roots(reps, range(TREES)).select("node", "doc")
    shared = met.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    often = met.join(shared, "node").groupBy("doc").agg(F.count("*").alias("n")).where(F.col("n") >= _ACTIVE)
    ids = often.select(F.col("doc").alias("_doc"))
    texts = materialized(docs.select(F.col("doc_id").alias("doc"), "text").join(ids, F.col("doc") == F.col("_doc"), "left_semi"))
    active = materialized(reps.join(_profiles(texts), "doc"))

    tied = components(materialized(_first_pairs(active)).toDF("u", "v"))
    more = _walk(active, tied, range(TREES)).toDF("u", "v")
    clusters = components(tied.select(F.col("vertex").alias("u"), F.col("component").alias("v")).union(more))
    links = materialized(_links(clusters, texts, percent).union(_same_documents(known, classes)))
    comps = components(links)
    discard(texts, active, links)
    return sketched, classes, comps


def _same_documents(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges between the classes of rows that share a doc_id."""
    twice = known.groupBy("doc_id").agg(F.min("set_hash").alias("lo"), F.max("set_hash").alias("hi")).where("lo <> hi")
    rows = known.join(twice.select("doc_id"), "doc_id").join(classes, "set_hash")
    return rows.select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
