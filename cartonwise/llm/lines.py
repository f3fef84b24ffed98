"""Repeated line runs, by prefix doubling over the corpus as sequences of line ids.

The suffix at each line is ranked by its first line, then by its first 2, 4, 8 ... lines: the rank of a doubled window is the
rank of the pair of its halves. Suffixes of one rank are an interval of the suffix array, whose longest common prefix reaches
that far. Suffixes that are alone are in their final place and leave, so a round works only on the runs that are still
repeated, and the rounds end when the longest repeated run is passed.

A maximal run of any length is the union of the windows that stand in intervals of these depths: a window as long as the
greatest power of two within it starts where the run starts, another ends where it ends. Only runs too short for their windows to have
the words that are asked for need depths of their own; these are ranked too, as pairs of a power of two and a rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.config import materialized
from cartonwise.llm.tables import BLANKS, WORD_SPACE, whole_row
from cartonwise.operators.numbering import number_rows

_DOC = ["doc_id", "version"]
_PLACE = [*_DOC, "seq"]


def _word_count(line: Column) -> Column:
    return F.size(F.split(F.trim(line, F.lit(BLANKS)), WORD_SPACE))


def sequences(docs: DataFrame) -> DataFrame:
    """The lines that have a word: doc_id, version (a hash of the text), seq (their number among these), line (number in the
    text), a and b (the line's id, two hashes), words."""
    text = docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("version"), "text")
    exploded = text.select(*_DOC, F.posexplode(F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("line"), x.alias("x"))),
        lambda s: F.trim(s["x"], F.lit(BLANKS)) != "")).alias("seq", "s"))
    return exploded.select(*_PLACE, "s.line", F.xxhash64("s.x").alias("a"), F.xxhash64(F.lit("line"), "s.x").alias("b"),
                           _word_count(F.col("s.x")).cast("long").alias("words"))


def _ranked(rows: DataFrame) -> DataFrame:
    """Repeated suffixes of rows (place, a, b, words) with rank, the place of (a, b) among all repeated ones, and the place
    where (a, b) first stands."""
    classes = rows.groupBy("a", "b").agg(F.min(F.struct(*_PLACE)).alias("first"), F.max(F.struct(*_PLACE)).alias("last"))
    repeated = number_rows(classes.where("first <> last").select("a", "b", "first"), [F.col("a"), F.col("b")], "rank")
    return rows.join(repeated, ["a", "b"]).select(
        *_PLACE, "rank", "words", (F.col("first") < F.struct(*_PLACE)).alias("later"))


def _joined(head: DataFrame, length: int, tail: DataFrame) -> DataFrame:
    """Windows that begin as those of head, which have `length` lines, and go on as those of tail: place, a, b, words."""
    after = tail.select(*_DOC, (F.col("seq") - length).alias("seq"), F.col("rank").alias("b"), F.col("words").alias("more"))
    return head.join(after, _PLACE).select(*_PLACE, F.col("rank").alias("a"), "b", (F.col("words") + F.col("more")).alias("words"))


def repeated_windows(lines: DataFrame, min_words: int) -> DataFrame:
    """Windows that stand in several places, of 1, 2, 4 ... lines and of every length up to min_words: place, length, words, later
    (not the first place). A line has a word at least, so a longer run has windows of min_words words at its ends."""
    # Repeated rows of one text hold the same places.
    ranked = {1: materialized(_ranked(lines.select(*_PLACE, "a", "b", "words")).dropDuplicates(_PLACE))}
    length = 1
    while not ranked[length].isEmpty():
        ranked[length * 2] = materialized(_ranked(_joined(ranked[length], length, ranked[length])))
        length *= 2
    for odd in range(3, min_words + 1):
        head = 1 << (odd.bit_length() - 1)
        if odd != head and head in ranked:
            ranked[odd] = materialized(_ranked(_joined(ranked[head], head, ranked[odd - head])))
    windows = [rows.select(*_PLACE, F.lit(n).alias("length"), "words", "later") for n, rows in ranked.items()]
    return reduce(DataFrame.union, windows)


def later_lines(docs: DataFrame, min_words: int = 3) -> DataFrame:
    """doc_id, version, dropped: the numbers of a text's lines that lie in a later copy of a run, of any number of lines, with
    min_words words or more. A copy is later if its doc_id, then version, then line number is greater."""
    lines = materialized(sequences(docs))
    windows = repeated_windows(lines, min_words)
    ends = windows.where(F.col("later") & (F.col("words") >= min_words)).groupBy(*_PLACE).agg(
        F.max(F.col("seq") + F.col("length")).alias("end"))
    # Every line of a repeated window is itself a repeated window of one line.
    rows = windows.where("length = 1").select(*_PLACE).join(ends, _PLACE, "left")
    reach = F.expr("max(end) over (partition by doc_id, version order by seq)")
    covered = rows.withColumn("reach", reach).where("reach > seq").select(*_PLACE)
    return covered.join(lines.select(*_PLACE, "line").distinct(), _PLACE).groupBy(*_DOC).agg(F.collect_set("line").alias("dropped"))


def _without(text: Column, dropped: Column) -> Column:
    """text without the lines of the given numbers; a number is looked up once, however many there are."""
    return F.transform(F.array(F.split(text, "\n")), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped), lambda i: lines[i]), "\n"))[0]


def _with_dropped(docs: DataFrame, min_words: int) -> DataFrame:
    """row (all columns of docs) and dropped (null if no line goes)."""
    dropped = materialized(later_lines(docs, min_words))
    rows = docs.select(whole_row(docs).alias("row"))
    return rows.join(dropped, (F.col("row.doc_id") == F.col("doc_id")) & (F.xxhash64("row.text") == F.col("version")), "left").select(
        "row", "dropped")


def drop_later_copies(docs: DataFrame, min_words: int = 3) -> DataFrame:
    """One row for each row of docs: doc_id, n_lines, n_dropped, text without the lines of later copies.

    Copies are found within and across documents; lines without a word are never dropped, nor part of a run. Rows of one
    doc_id and text are one document, so neither is a copy of the other; null doc_ids keep their texts; a null text has
    no lines and stays null. Only doc_id and text are read.
    """
    found = _with_dropped(docs.select("doc_id", "text"), min_words)
    return found.select(
        "row.doc_id", F.when(F.col("row.text").isNull(), 0).otherwise(F.size(F.split("row.text", "\n"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(_without(F.col("row.text"), F.col("dropped"))).alias("text"))


def clean(docs: DataFrame, min_words: int = 3) -> DataFrame:
    """docs with the lines of later copies taken out of text, n_chars (if there is one) counted anew, and without the rows that
    have lost every line with a word. Other columns stay, whatever they are called."""
    found = _with_dropped(docs, min_words)
    text = F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(_without(F.col("row.text"), F.col("dropped")))
    found = found.select("row", "dropped", text.alias("text"))
    found = found.where(F.col("dropped").isNull() | (F.trim("text", F.lit(BLANKS)) != ""))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("dropped").isNull(), F.col("row.n_chars")).otherwise(
        F.length("text").cast("long"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return found.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


ORACLE_SQL = r"""
with recursive texts as (select distinct doc_id, text from documents where doc_id is not null and text is not null),
split as (select doc_id, text, unnest(string_split(text, chr(10))) as x, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line
          from texts),
seqs as (select doc_id, text, md5(text) as t, line, x, md5(x) as xh, row_number() over (partition by doc_id, text order by line) as seq,
                len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) as words
         from split where regexp_matches(x, '[^\x20\x09-\x0D]')),
runs as (  -- windows of every length that stand in several places, each a line longer than one before
  select doc_id, t, seq, 1 as length, words, h, f from (
    select doc_id, t, seq, words, xh as h, count(*) over (partition by xh) as n,
           min(struct_pack(d := doc_id, s := seq)) over (partition by xh) as f from seqs) where n > 1
  union all
  select doc_id, t, seq, length, words, h, f from (
    select r.doc_id, r.t, r.seq, r.length + 1 as length, r.words + q.words as words, md5(r.h || q.xh) as h,
           count(*) over (partition by md5(r.h || q.xh)) as n, min(struct_pack(d := r.doc_id, s := r.seq)) over (partition by md5(r.h || q.xh)) as f
    from runs r join seqs q on q.doc_id = r.doc_id and q.t = r.t and q.seq = r.seq + r.length) where n > 1),
late as (select doc_id, t, seq, max(length) as length from runs where (f.d, f.s) < (doc_id, seq) and words >= 3 group by all),
dropped as (select distinct q.doc_id, q.text, q.line from seqs q join late l
            on q.doc_id = l.doc_id and q.t = l.t and q.seq between l.seq and l.seq + l.length - 1),
kept as (select s.doc_id, s.text, count(*) as n_lines, count(d.line) as n_dropped,
                coalesce(string_agg(case when d.line is null then s.x end, chr(10) order by s.line), '') as rest
         from split s left join dropped d on s.doc_id = d.doc_id and s.text = d.text and s.line = d.line group by all)
select d.doc_id, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_dropped, 0) as n_dropped,
       coalesce(k.rest, d.text) as text
from documents d left join kept k on d.doc_id = k.doc_id and d.text = k.text
"""
