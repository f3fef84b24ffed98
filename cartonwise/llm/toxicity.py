"""Toxicity scores: gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

A lexicon of insults is joined by terms learned from labelled texts, words and word beginnings, which carries over to other
languages. Lexicon, trees and calibration learn from different parts of the labelled rows, so none trusts what another has
learned by heart.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.tables import held_out, map_texts

# Insults, and words that address the reader, in several languages.
INSULTS = """idiot idiots idiotic stupid moron morons moronic dumb dumbass loser losers pathetic worthless disgusting scum trash
garbage clown jerk fool foolish imbecile retard freak pig pigs filthy filth vermin parasite coward liar hate shut ugly
bastard bitch crap damn asshole bullshit fuck fucking shit dummkopf idioten arschloch scheisse blöd abschaum connard
salaud ordure imbécile merde idiota imbécil basura asqueroso mierda cabrón gilipollas""".split()
SECOND_PERSON = """you your yours yourself u ur youre du dich dir dein deine ihr euch tu te ton ta tes toi vous votre vos ti
usted ustedes tus vosotros""".split()

FEATURES = ("log_words", "insults", "learned_words", "learned_stems", "learned_weight", "hits", "n_insults", "n_learned_words",
            "n_learned_stems", "second_person", "near_second_person",
            "upper", "upper_words", "marks", "exclamations", "symbols", "digits", "obfuscated", "obfuscated_hits", "stretched")
_LEXICON = frozenset(w.encode() for w in INSULTS)
_SECOND = frozenset(w.encode() for w in SECOND_PERSON)
_STEM_BYTES, _NEAR_WORDS = (4, 6), 5
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_TO_WORDS = bytes(32 if c in _PUNCTUATION else c for c in range(256))
_DISGUISE = bytes.maketrans(b"@$013457!", b"asoieasti")
_DISGUISED = re.compile(rb"[a-z]+[@$*!0-9]+[a-z]+")
_DISGUISES = b"@$*!0123456789"
_STRETCHED = re.compile(rb"([a-z])\1\1")
_UPPER, _LOWER_LETTERS = bytes(range(65, 91)), bytes(range(97, 123))


def _words(text: bytes) -> list[bytes]:
    return text.lower().translate(_TO_WORDS).split()


def _stems(word: bytes) -> list[bytes]:
    return [b"^" + word[:n] for n in _STEM_BYTES if len(word) > n]


def terms(text: bytes) -> set[bytes]:
    """The words of a text and the beginnings of longer ones, these marked by ^."""
    words = set(_words(text))
    return words | {s for w in words for s in _stems(w)}


def features(text: bytes, learned: dict[bytes, float]) -> list[float]:
    """FEATURES of a text. Densities are per word or per character and count every occurrence, n_ features count different words;
    the empty text has zeros."""
    words = _words(text)
    if not words:
        return [0.0] * len(FEATURES)
    count, size = len(words), len(text)
    distinct = set(words)
    bad = {w for w in distinct if w in _LEXICON}
    by_word = {w for w in distinct if w in learned}
    by_stem = {w for w in distinct if any(s in learned for s in _stems(w))} if learned else set()
    hits = bad | by_word | by_stem
    places = [i for i, w in enumerate(words) if w in hits] if hits else []
    second = [i for i, w in enumerate(words) if w in _SECOND] if distinct & _SECOND else []
    near = 0
    if places and second:
        at = np.searchsorted(second, places)
        ends = np.array([-10**9, *second, 10**9])
        near = int((np.minimum(np.abs(ends[at] - places), np.abs(ends[at + 1] - places)) <= _NEAR_WORDS).sum())
    weights = {w: max(learned.get(t, 0.0) for t in (w, *_stems(w))) for w in by_word | by_stem}
    found = [words[i] for i in places]  # with repetitions: a text that says one insult over and over is as dense as it reads
    weight = sum(weights.get(w, 0.0) for w in found)
    n_bad, n_word, n_stem = (sum(w in kind for w in found) for kind in (bad, by_word, by_stem))
    n_upper = size - len(text.translate(None, _UPPER))
    n_letters = n_upper + size - len(text.translate(None, _LOWER_LETTERS))
    marks, digits = size - len(text.translate(None, _PUNCTUATION)), size - len(text.translate(None, b"0123456789"))
    odd = size - len(text.translate(None, b"#*$%&|<>@^~"))
    disguised, disguised_hits = 0, 0
    if len(text.translate(None, _DISGUISES)) < size:
        for word in _DISGUISED.findall(text.lower()):
            disguised += 1
            plain = word.translate(_DISGUISE)
            disguised_hits += plain in _LEXICON or any(t in learned for t in (plain, *_stems(plain)))
    upper_words = sum(w.isupper() and len(w) > 1 for w in text.split()) if n_upper > 1 else 0
    stretched = len(_STRETCHED.findall(text.lower()))
    return [float(np.log1p(count)), n_bad / count, n_word / count, n_stem / count, weight / count,
            float(np.log1p(len(places))), float(len(bad)),
            float(len(by_word)), float(len(by_stem)), len(second) / count, near / count, n_upper / max(1, n_letters), upper_words / count,
            marks / size, text.count(b"!") / count, odd / size, digits / size, disguised / count, disguised_hits / count,
            stretched / count]


def _known(labels: DataFrame) -> DataFrame:
    """(doc_id, label, part) of labels to learn from. Null and contradictory ones teach nothing."""
    return (labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id")
            .agg(F.min("toxic").alias("label"), F.max("toxic").alias("_most")).where("label = _most")
            .select("doc_id", "label", F.pmod(F.xxhash64("doc_id"), F.lit(10)).alias("part")))


def _sampled(known: DataFrame, most: int) -> DataFrame:
    """About `most` rows of each label, chosen by a hash of the id."""
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    share = F.when(F.col("label") == 1, min(1.0, most / max(1, counts.get(1, 0)))).otherwise(min(1.0, most / max(1, counts.get(0, 0))))
    return known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003)) < share * 1_000_003)


def learn_terms(docs: DataFrame, sampled: DataFrame, least_documents: int = 4, least_weight: float = 2.5,
                most_terms: int = 3000) -> dict[bytes, float]:
    """Terms with their log odds to stand in a toxic text rather than another one. sampled: doc_id and label of a bounded
    number of documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(label, term) for text, label in zip(batch.column(1), batch.column(2).to_pylist())
                     for term in terms((text.as_py() or "").encode())]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())],
                                             ["label", "term"])

    sampled = materialized(sampled.select(F.col("doc_id").alias("_id"), F.col("label").cast("int").alias("label")))
    sizes = sampled.agg(F.sum("label"), F.sum(1 - F.col("label"))).first()
    if not sizes[0] or not sizes[1]:
        return {}
    own = docs.select("doc_id", "text").join(sampled, F.col("doc_id") == F.col("_id"))
    counts = (map_texts(own, work, "label int, term binary", ("doc_id", "text", "label")).groupBy("term")
              .agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")).where(F.col("p") >= least_documents))
    odds = F.log((F.col("p") + 0.5) / (sizes[0] - F.col("p") + 0.5)) - F.log((F.col("n") + 0.5) / (sizes[1] - F.col("n") + 0.5))
    best = (counts.withColumn("weight", odds).where(F.col("weight") >= least_weight)
            .orderBy(F.desc("p"), F.desc("weight"), "term").limit(most_terms))
    found = {bytes(r.term): (r.weight, r.p) for r in best.collect()}
    words = [(w, p) for w, (_, p) in found.items() if w[:1] != b"^"]
    # A beginning that stands for one word only says nothing that the word doesn't.
    single = {t for t, (_, p) in found.items() if t[:1] == b"^" and any(w.startswith(t[1:]) and n >= 0.8 * p for w, n in words)}
    return {t: weight for t, (weight, _) in found.items() if t not in single}


def measure(docs: DataFrame, learned: dict[bytes, float]) -> DataFrame:
    """doc_id and FEATURES of each row of docs; a null text counts as an empty one. Only doc_id and text are read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features((text.as_py() or "").encode(), learned) for text in batch.column(1)]
            values = np.array(rows).reshape(len(rows), len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(values[:, i]) for i in range(len(FEATURES)))],
                                             ["doc_id", *FEATURES])

    return map_texts(docs, work, "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES))


def score(docs: DataFrame, labels: DataFrame, most_labelled: int = 3000, most_rows: int = 30_000, trees: int = 20,
          depth: int = 4) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs, learned from the labels of documents that aren't held out.

    About most_labelled documents of each label teach the lexicon, about most_rows of each the trees and the calibration: the
    labels' hash parts 0-4, 5-7 and 8-9. Features of all documents are written once, and labels are joined to them, not to
    texts. If a part lacks one of the labels, all scores are the known share of toxic documents (0 without labels). Repeated
    rows each get a row; a hundredth of the score is the uncalibrated one, which tells texts of one calibration step apart.
    """
    known = materialized(_known(labels))
    learned = learn_terms(docs, _sampled(known.where("part < 5"), most_labelled))
    measured = materialized(measure(docs, learned))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    teaching = materialized(measured.join(_sampled(known, most_rows), "doc_id"))
    parts = {(r.part, r.label): r["count"] for r in
             teaching.withColumn("part", F.expr("case when part < 5 then 0 when part < 8 then 1 else 2 end"))
             .groupBy("part", "label").count().collect()}
    if not all(parts.get((part, label)) for part in (1, 2) for label in (0, 1)):
        toxic, total = sum(n for (_, label), n in parts.items() if label == 1), sum(parts.values())
        found = measured.select("doc_id", F.lit(toxic / total if total else 0.0).alias("score"))
    else:
        rows = assembled.transform(teaching).select("part", F.col("label").cast("double").alias("label"), "features")
        boosted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=64, seed=3).fit(rows.where("part between 5 and 7"))
        margin = vector_to_array("rawPrediction")[1]
        calibrated = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="level").fit(
            boosted.transform(rows.where("part > 7")).select(margin.alias("margin"), "label"))
        judged = boosted.transform(assembled.transform(measured)).select("doc_id", margin.alias("margin"))
        found = calibrated.transform(judged).select("doc_id", (
            0.99 * F.col("level") + 0.01 / (1 + F.exp(-2 * F.col("margin")))).alias("score"))
    return found.select("doc_id", held_out().alias("held_out"), F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"),
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
