"""Language identification by a convolutional network over bytes, trained in numpy.

Bytes are embedded, filters of several widths slide over a fixed-length window, each filter keeps its strongest response, and
a softmax gives a probability for every language. A text is cut into windows, all of them, and their probabilities are
averaged. When the network is applied, embedding and filters are one table per place in the filter, so a response is a
sum of looked-up rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.llm.tables import held_out, map_texts, small_batches
from cartonwise.llm.text_arrays import texts_of

UNKNOWN = "und"
WIDTHS = (2, 3, 4)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = True
_BLOCK = 64  # windows at a time, so that responses stay in the processor's cache


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    window: int
    tables: np.ndarray  # place in the filter, byte, filter
    bias: np.ndarray  # filter
    dense: np.ndarray  # filter, language
    dense_bias: np.ndarray  # language

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """windows: rows of window + widest filter - 1 bytes, zeros at the end."""
        found = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), _BLOCK):
            block = windows[at:at + _BLOCK]
            total = self.tables[0][block[:, :self.window]]
            for place in range(1, len(self.tables)):
                total += self.tables[place][block[:, place:place + self.window]]
            pooled = np.maximum(total.max(1) + self.bias, 0)
            found[at:at + _BLOCK] = _softmax(pooled @ self.dense + self.dense_bias)
        return found


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def windows_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """The bytes from each start on, in lower case, zeros from the text's end or the window's end on."""
    places = starts[:, None] + np.arange(window)
    found = np.zeros((len(starts), window + max(WIDTHS) - 1), np.uint8)
    inside = places < ends[:, None]
    found[:, :window][inside] = _LOWER[data[places[inside]]]
    return found


def train(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], filters: int = 8, dimension: int = 8,
          epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 5) -> Network:
    """Adam on the cross entropy. Only a filter's strongest place gets a gradient, so going back is cheap."""
    random = np.random.default_rng(seed)
    window, count = windows.shape[1] - max(WIDTHS) + 1, len(WIDTHS) * filters
    embedding = random.normal(0, 0.5, (256, dimension)).astype(np.float32)
    kernel = random.normal(0, 0.3, (max(WIDTHS), dimension, count)).astype(np.float32)
    reach = np.repeat(WIDTHS, filters)
    mask = (np.arange(max(WIDTHS))[:, None, None] < reach).astype(np.float32)  # narrow filters end early
    kernel *= mask
    bias, dense = np.zeros(count, np.float32), random.normal(0, 0.1, (count, len(languages))).astype(np.float32)
    dense_bias = np.zeros(len(languages), np.float32)
    weights = [embedding, kernel, bias, dense, dense_bias]
    means, squares, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = random.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            x, truth = windows[rows], labels[rows]
            tables = np.einsum("bd,pdf->pbf", embedding, kernel)
            total = sum(tables[p][x[:, p:p + window]] for p in range(max(WIDTHS)))
            where, best = total.argmax(1), total.max(1) + bias
            pooled = np.maximum(best, 0)
            error = _softmax(pooled @ dense + dense_bias)
            error[np.arange(len(rows)), truth] -= 1
            error /= len(rows)
            back = (error @ dense.T) * (best > 0)  # row, filter
            bytes_seen = x[np.arange(len(rows))[:, None, None], where[:, :, None] + np.arange(max(WIDTHS))]  # row, filter, place
            kernel_change = np.einsum("rf,rfpd->pdf", back, embedding[bytes_seen]) * mask
            embedding_change = np.zeros_like(embedding)
            np.add.at(embedding_change, bytes_seen, np.einsum("rf,pdf->rfpd", back, kernel))
            step += 1
            for i, change in enumerate((embedding_change, kernel_change, back.sum(0), pooled.T @ error, error.sum(0))):
                means[i] += 0.1 * (change - means[i])
                squares[i] += 0.001 * (change * change - squares[i])
                weights[i] -= rate * (means[i] / (1 - 0.9 ** step)) / (np.sqrt(squares[i] / (1 - 0.999 ** step)) + 1e-8)
    return Network(languages, window, np.einsum("bd,pdf->pbf", embedding, kernel).astype(np.float32), bias, dense, dense_bias)


def learn(docs: DataFrame, documents_per_language: int = 600, windows_per_document: int = 4, window: int = 256) -> Network | None:
    """A network from rows of text and lang that aren't held out. About documents_per_language documents of each language,
    chosen by a hash of their id, with windows_per_document windows of each: this bounds what reaches the driver, whatever
    the number of rows. None if no row has a language."""
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != ""))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    share = F.lit(0.0)
    for language, count in sorted(counts.items()):
        share = F.when(F.col("lang") == language, min(1.0, documents_per_language / count)).otherwise(share)
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < share * 1_000_003)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, languages = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows: list[tuple] = []
            for first, end, data, offsets in texts_of(batch.column(1)):
                for i in range(first, end):
                    start, stop = int(offsets[i - first]), int(offsets[i - first + 1])
                    own = np.random.default_rng(abs(ids[i]) + 1)  # the same places in every run
                    starts = own.integers(start, max(start + 1, stop - window // 2), windows_per_document)
                    found = windows_of(data, starts, np.full(len(starts), stop), window)
                    rows += [(ids[i], k, languages[i], w.tobytes()) for k, w in enumerate(found)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 4, (pa.int64(), pa.int32(), pa.string(), pa.binary()))],
                ["doc_id", "number", "lang", "window"])

    rows = sorted(map_texts(chosen, work, "doc_id long, number int, lang string, window binary",
                            ("doc_id", "text", "lang")).distinct().collect())
    if not rows:
        return None
    languages = tuple(sorted({r.lang for r in rows}))
    place = {language: i for i, language in enumerate(languages)}
    windows = np.frombuffer(b"".join(r.window for r in rows), np.uint8).reshape(len(rows), -1)
    return train(windows, np.array([place[r.lang] for r in rows]), languages)


def _judge(column: pa.Array, network: Network | None) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text of a column."""
    found, scores = [UNKNOWN] * len(column), np.zeros(len(column))
    for first, _, data, offsets in texts_of(column):
        if network is None or not len(data):
            continue
        letters = np.concatenate([[0], np.cumsum(_LETTERS[data])])[offsets]
        lengths = np.diff(offsets)
        judged = np.diff(letters) > 0
        for i in np.flatnonzero(~judged & (lengths > 0)).tolist():
            judged[i] = any(map(str.isalpha, data[offsets[i]:offsets[i + 1]].tobytes().decode(errors="replace")))
        rows = np.flatnonzero(judged)
        if not len(rows):
            continue
        counts = -(-lengths[rows] // network.window)
        owner = np.repeat(np.arange(len(rows)), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = offsets[rows][owner] + number * network.window
        ends = offsets[rows + 1][owner]
        weights = np.minimum(network.window, ends - starts)
        totals = np.zeros((len(rows), len(network.languages)))
        for at in range(0, len(owner), 2048):
            part = slice(at, at + 2048)
            own = network.probabilities(windows_of(data, starts[part], ends[part], network.window))
            np.add.at(totals, owner[part], own * weights[part, None])
        totals /= lengths[rows][:, None]
        best = totals.argmax(1)
        scores[first + rows] = totals[np.arange(len(rows)), best].clip(0, 1)
        for row, language in zip(rows.tolist(), best.tolist()):
            found[first + row] = network.languages[language]
    return found, scores


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the averaged probability of lang_pred) for each row of docs. A null text, or one
    without a letter, is `und` with score 0, as is every text if there is no network. Rows are independent; only doc_id and
    text are read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = _judge(batch.column(1), network)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found, pa.string()), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    return map_texts(docs, work, "doc_id long, lang_pred string, score double").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, network: Network | None, least_score: float = 0.4) -> DataFrame:
    """The rows of docs, with all their columns, that have a language: not `und`, and a score of least_score. Without a
    network, which no document taught, all rows stay."""
    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, scores = _judge(batch.column(place), network)
            keep = pa.array([x != UNKNOWN for x in found], pa.bool_()).to_numpy(zero_copy_only=False) & (scores >= least_score)
            yield batch.filter(pa.array(keep))

    small_batches(docs.sparkSession)
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # mapInArrow does not take names with dots
    return docs if network is None else plain.mapInArrow(work, plain.schema).toDF(*docs.columns)


def identify(docs: DataFrame, **options) -> DataFrame:
    """predict() by a network learned from docs itself, from rows that aren't held out."""
    return predict(docs, learn(docs, **options))
