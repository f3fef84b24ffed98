import hashlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartonwise.llm import infill, tables
from cartonwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_rule(doc_id, text):
    """The same by a loop over the units."""
    text = text or ""
    ends, at = [], 0
    while at < len(text):
        at = re.compile(infill.UNIT).match(text, at).end()
        ends.append(at)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(ends)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, text, text)
    low, high = sorted(([0, *ends][h1 % (n + 1)], [0, *ends][h2 % (n + 1)]))
    a, b, c = text[:low], text[low:high], text[high:]
    form = "spm" if h4 % 100 < 80 else "psm"
    output = f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}"
    return (doc_id, n, form, low, high - low, output, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \t\n\x0b\x0c\rab<PSM>é\U0001f600\x1c ", max_size=40))
def test_ends_of_one_match_are_those_of_a_loop(text):
    at, ends = 0, []
    while at < len(text):
        at = re.compile(infill.UNIT).match(text, at).end()
        ends.append(at)
    assert infill.unit_ends(text) == ends


def test_rows_and_round_trip(spark, frame):
    own = random.Random(5)
    texts = [None, "", " ", "\n\n", "one", "  lead", "trail  ", "a <P> b", "x<S>", "<M>", "<<P", "P> <S M>", " em\x1cspace", "\U0001f600 \U0001f600",
             "\x00nul \x00"]
    texts += ["".join(own.choice(" \n\tab<>PSMé") for _ in range(own.randrange(60))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "again"), (3, "again"), (None, "no id"), (-7, "minus seven words of text")]
    docs = frame(rows).withColumns({"n": F.lit(1), "form": F.lit("x"), "output": F.lit("y"), "text_2": F.lit("z")})
    got = infill.transform(docs).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_rule(*r) for r in rows), key=str)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}


def test_parameters(frame):
    rows = frame([(i, "one two three four") for i in range(200)])
    assert {r.form for r in infill.transform(rows, rate=0).collect()} == {"plain"}
    assert {r.form for r in infill.transform(rows, rate=100, spm_share=0).collect()} == {"psm"}
    assert infill.transform(rows, seed=1).collect() != infill.transform(rows, seed=2).collect()


def test_empty_table(frame):
    assert infill.digests(frame([])).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert infill.digests(frame([])).collect() == []


@pytest.mark.parametrize("text", ["a " * 2_000_000, "a" * 3_000_000, " " * 3_000_000])
def test_long_texts(frame, text):
    row = infill.transform(frame([(8, text)]), rate=100).first()
    expected = 1 if " " not in text or not text.strip() else 2_000_001
    assert row.n == expected and row.output.count("<P>") == 1 and len(row.output) == len(text) + 9


def test_query_whole_table(spark):
    got = QUERIES["op12_fill_in_middle"](spark, SMALL).collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = [(*(r := plain_rule(d.doc_id, d.text))[:5], sha(r[5]), sha(r[6])) for d in tables.documents(spark, SMALL).collect()]
    assert sorted(map(tuple, got)) == sorted(want, key=lambda r: r[0])


def test_sql_agrees(spark):
    connection = duckdb.connect()
    connection.sql(f"create view documents as select * from '{SMALL}/documents.parquet'")
    assert sorted(connection.sql(infill.ORACLE_SQL).fetchall()) == sorted(map(tuple, QUERIES["op12_fill_in_middle"](spark, SMALL).collect()))
