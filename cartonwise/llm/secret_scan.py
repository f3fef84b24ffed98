"""Secrets in texts: fixed patterns, and values in a credential context that take too many guesses to be placeholders."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.guesses import cheapest_parts, ranked
from cartonwise.llm.tables import map_texts

# Kinds in the order in which spans of one place are listed, and the base patterns.
KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_ASSIGN_STEMS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_WORD = re.compile(rb"(?<![A-Za-z0-9])[a-z]{3,24}(?![A-Za-z0-9])")
_HEX_SHAPE = bytes(49 if c in b"0123456789abcdef" else 48 for c in range(256))

# Names before which a value is a credential, beyond the base pattern's; also user:value@host in a URL.
_STEMS = (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"bearer", b"credential", b"login", b"session", b"://")
_CONTEXT = re.compile(
    rb"(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret|signing|encryption)[-_\x20]?key|"
    rb"auth(?:orization)?|credentials?|login|session[-_]?id)[\"']?(?:\x20*(?::=|=>|[:=])\x20*|\x20+is\x20+)(?:bearer\x20+|basic\x20+)?"
    rb"|bearer\x20+|://[^\s:/@]+:(?=[^\s/@]+@))[\"']?([^\s\"'<>,;|@]+)", re.I)


def base_spans(data: bytes, lower: bytes) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the value) in bytes of a text's bytes."""
    found = []
    if any(stem in lower for stem in _ASSIGN_STEMS):
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in _ASSIGN.finditer(data) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in data:
        found += [(m.start(), m.end(), "access", m.start()) for m in _ACCESS.finditer(data) if m.end() - m.start() >= 20]
    if b"1" * 24 in data.translate(_HEX_SHAPE):
        found += [(m.start(), m.end(), "hex", m.start()) for m in _HEX.finditer(data)]
    return found


def guess_spans(data: bytes, lower: bytes, base: list[tuple[int, int, str, int]], least_guesses: float,
                least_length: int, learned: dict[str, float] | None = None) -> list[tuple[int, int, str, int]]:
    """Values in a credential context that take 10**least_guesses guesses or more and touch no base span."""
    if not any(stem in lower for stem in _STEMS):
        return []
    found, taken = [], sorted((s, e) for s, e, _, _ in base)
    for match in _CONTEXT.finditer(data):
        start, end = match.span(1)
        value = data[start:end].rstrip(b".!?)]}").decode(errors="replace")
        end = start + len(value.encode())
        if len(value) < least_length or any(s < end and start < e for s, e in taken):
            continue
        if cheapest_parts(value, learned or {})[0] >= least_guesses:
            found.append((start, end, "guess", start))
    return found


def find(text: str, least_guesses: float = 10.0, least_length: int = 8, learned: dict[str, float] | None = None) -> tuple[list[tuple[int, int, str]], list[float]]:
    """(spans as (start, end, kind) in code points, by start and kind; the decimal logarithms of the guesses that the values
    of assign and guess spans take)."""
    data = text.encode()
    lower = data.lower()
    base = base_spans(data, lower)
    spans = sorted(base + guess_spans(data, lower, base, least_guesses, least_length, learned),
                   key=lambda s: (s[0], KINDS.index(s[2])))
    guesses = [cheapest_parts(data[v:e].decode(errors="replace"), learned or {})[0] for _, e, kind, v in spans if kind in ("assign", "guess")]
    if len(data) == len(text):
        return [(s, e, kind) for s, e, kind, _ in spans], guesses
    places = sorted({p for s, e, _, _ in spans for p in (s, e)})
    points, at, count = {}, 0, 0
    for place in places:
        count += len(data[at:place].decode())
        at, points[place] = place, count
    return [(points[s], points[e], kind) for s, e, kind, _ in spans], guesses


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for s, e, kind in spans)


def usual_words(docs: DataFrame, most_words: int = 20_000, least_documents: int = 3) -> list[str]:
    """The words of ASCII letters that most documents have, in small letters and in that order: at most most_words, each in
    least_documents or more. A task counts its documents before anything is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for text in batch.column(0):
                counts.update(set(_WORD.findall((text.as_py() or "").encode().lower())))
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())],
                                             ["word", "documents"])

    counted = map_texts(docs, work, "word string, documents long", ("text",)).groupBy("word").agg(F.sum("documents").alias("documents"))
    # Written first: a collected limit would send most_words rows of every partition to the driver.
    best = materialized(counted.where(F.col("documents") >= least_documents).orderBy(F.desc("documents"), "word").limit(most_words))
    return [r.word for r in sorted(best.collect(), key=lambda r: (-r.documents, r.word))]


def scan(docs: DataFrame, least_guesses: float = 10.0, least_length: int = 8, most_words: int = 20_000) -> DataFrame:
    """One row for each row of docs: doc_id; n_assign, n_access, n_hex; base_sha256 of the base spans; spans, all as
    kind:start:end; n_guess, spans that only the guess cost finds; max_guesses, the most that a value takes (decimal
    logarithm; null without values). Parts of a value may be words of a fixed list, or of the most_words words that most of
    docs have: in prose, a word after "password is" is no secret. A null text has no spans. Rows are independent, so only words'
    counts are shuffled; columns other than doc_id and text are not read."""
    learned = docs.sparkSession.sparkContext.broadcast(ranked(usual_words(docs, most_words)))  # most_words words at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans, guesses = find(text.as_py() or "", least_guesses, least_length, learned.value)
                base = [s for s in spans if s[2] != "guess"]
                rows.append([*(sum(s[2] == kind for s in spans) for kind in KINDS[:3]),
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                             len(spans) - len(base), max(guesses, default=None)])
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "max_guesses"])

    return map_texts(docs, work, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
                                 "n_guess long, max_guesses double")
