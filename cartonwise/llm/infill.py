"""Fill-in-middle transformation: a text's units cut into prefix, middle and suffix, in an order a left-to-right model can learn.

A unit is a word with the white space before it, or white space at the end. One full match of the repeated unit keeps where
every repetition ends, so the number of units and both cuts are read off a single match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartonwise.llm.tables import map_texts

# A unit, and the marks of prefix, suffix and middle.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKS = ("<P>", "<S>", "<M>")


@cache
def _units() -> regex.Pattern:
    return regex.compile(f"({UNIT})*+")  # possessive: the units of a text are unique, so nothing is kept to go back to


def unit_ends(text: str) -> list[int]:
    """Where each unit of the text ends, in code points."""
    return _units().fullmatch(text).ends(1)


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers that depend on the seed and the document alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at:at + 8], 16) for at in range(0, 32, 8)]


def transformed(doc_id: int | None, text: str, seed: int, rate: int, spm_share: int) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, characters of prefix and of middle, output) of one text."""
    ends = unit_ends(text)
    n = len(ends)
    first, second, whether, which = draws(doc_id, seed)
    if not text or whether % 100 >= rate or any(mark in text for mark in MARKS):
        return n, "plain", None, None, text
    cuts = [0, *ends]
    low, high = sorted((cuts[first % (n + 1)], cuts[second % (n + 1)]))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    p, s, m = MARKS
    if which % 100 < spm_share:
        return n, "spm", low, high - low, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", low, high - low, f"{p}{prefix}{s}{suffix}{m}{middle}"


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm_share: int = 80) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points, null if plain) and output for each
    row of docs. rate of 100 texts are transformed, spm_share of 100 of these suffix first; which ones depends on seed and
    doc_id alone, so repeated rows and reruns agree. A null text counts as an empty one and an empty text stays plain, as does
    one that holds a mark; a null doc_id draws like an empty one. Rows are independent and nothing is shuffled. Other columns
    are not read."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [transformed(i, t or "", seed, rate, spm_share) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            n, form, prefix, middle, output = map(list, zip(*rows)) if rows else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return map_texts(docs, work, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text behind an output of transform. Only marks can start with the first character of a mark there, as texts with a
    mark stay plain, so the parts between the marks are the text's own."""
    parts = F.split(output, "|".join(MARKS))  # an empty string, then the parts in the form's order
    prefix = F.when(form == "spm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    suffix = F.when(form == "spm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))


def digests(docs: DataFrame, seed: int = 42, rate: int = 50, spm_share: int = 80) -> DataFrame:
    """transform, with the output and the text restored from it as SHA-256 digests."""
    rows = transform(docs, seed, rate, spm_share)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE_SQL = """
with units as (
  select doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as units,
         sha256('42:' || cast(doc_id as varchar)) as h
  from documents),
drawn as (
  select doc_id, text, units, cast(len(units) as bigint) as n,
         cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
         cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from units),
formed as (
  select *, case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50
                 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form,
         least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high
  from drawn),
parts as (
  select *, coalesce(array_to_string(list_slice(units, 1, low), ''), '') as prefix,
         coalesce(array_to_string(list_slice(units, low + 1, high), ''), '') as middle,
         coalesce(array_to_string(list_slice(units, high + 1, n), ''), '') as suffix
  from formed)
select doc_id, n, form,
       case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
       sha256(case form when 'plain' then text when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from parts
"""
