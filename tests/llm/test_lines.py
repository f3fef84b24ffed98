import random
import re
from collections import defaultdict

import duckdb

from cartonwise.llm import lines, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, min_words=3):
    """By every window of every length."""
    rows = {(i, t): t.split("\n") for i, t in docs if i is not None and t is not None}
    sequences = {key: [(n, x) for n, x in enumerate(text) if WORD.search(x)] for key, text in rows.items()}
    places = defaultdict(list)
    for (doc, text), own in sequences.items():
        for length in range(1, len(own) + 1):
            for s in range(len(own) - length + 1):
                places[hash(tuple(x for _, x in own[s:s + length])), length].append((doc, text, s))
    dropped = defaultdict(set)
    for (_, length), found in places.items():
        first = min((d, s) for d, _, s in found)
        for doc, text, s in found if len(found) > 1 else ():
            window = sequences[doc, text][s:s + length]
            if (doc, s) > first and sum(len(WORD.findall(x)) for _, x in window) >= min_words:
                dropped[doc, text] |= {n for n, _ in window}
    result = []
    for doc, text in docs:
        own = text.split("\n") if text is not None else []
        gone = dropped.get((doc, text), set())
        result.append((doc, len(own), len(gone), None if text is None else "\n".join(x for n, x in enumerate(own) if n not in gone)))
    return result


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r))


def found(frame, docs, **options):
    return [tuple(r) for r in lines.drop_later_copies(frame(docs), **options).select("doc_id", "n_lines", "n_dropped", "text").collect()]


def test_against_every_window(frame):
    own = random.Random(7)
    for _ in range(3):
        docs = [(i, "\n".join(own.choices(["a", "b c", "d e f", "", " ", "g h", "i"], k=own.randint(0, 12)))) for i in range(25)]
        assert key(found(frame, docs)) == key(plain(docs))
    assert key(found(frame, docs, min_words=1)) == key(plain(docs, 1))
    words = [(i, "\n".join(own.choices(["a", "b", "c", "d", "e f", "g"], k=own.randint(0, 25)))) for i in range(30)]
    for least in (2, 3, 6, 7, 12):
        assert key(found(frame, words, min_words=least)) == key(plain(words, least))


def test_short_lines_go_only_with_their_run(frame):
    docs = [(1, "one\ntwo\nthree\nfour"), (2, "x\none\ntwo\nthree\nfour\ny"), (3, "two\nother words here")]
    assert key(found(frame, docs)) == [(1, 4, 0, docs[0][1]), (2, 6, 4, "x\ny"), (3, 2, 0, docs[2][1])]


def test_three_lines_of_one_word_each(frame):
    docs = [(1, "x\none\ntwo\nthree\ny"), (2, "one\ntwo\nthree"), (3, "one\ntwo\nother"), (4, "z\nthree\none\ntwo\nthree")]
    assert key(found(frame, docs)) == [(1, 5, 0, docs[0][1]), (2, 3, 3, ""), (3, 3, 0, docs[2][1]), (4, 5, 3, "z\nthree")]


def test_odd_rows(frame):
    long = "\n".join(f"line number {i}" for i in range(300))
    docs = [(5, None), (6, ""), (7, "same line again\nsame line again\n\nsame line again"), (8, long), (9, long), (9, long), (None, long),
            (10, "one more line\r"), (11, "one more line")]
    assert key(found(frame, docs)) == key(plain(docs))
    extra = frame(docs).selectExpr("*", "'v' as version", "1 as dropped", "2 as seq", "length(text) as n_chars", "3 as `a.b`")
    kept = {(r.doc_id, r.text): r for r in lines.clean(extra).collect()}
    assert (9, "") not in kept and (9, long) not in kept and (8, long) in kept and (None, long) in kept and (5, None) in kept and (6, "") in kept
    row = kept[7, "same line again\n"]
    assert (row.version, row.dropped, row.seq, row.n_chars, row["a.b"]) == ("v", 1, 2, len("same line again\n"), 3)
    assert lines.clean(extra).columns == extra.columns
    assert found(frame, []) == [] and lines.clean(frame([])).count() == 0


def test_a_hot_line(frame):
    docs = [(i, f"own line of {i}\nthe line that all have\nend of {i} here") for i in range(400)]
    rows = found(frame, docs)
    assert sorted(r[0] for r in rows if r[2] == 0) == [0] and all(r[2] == 1 for r in rows if r[0])


def test_query(spark):
    connection = duckdb.connect()
    connection.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    expected = connection.execute(queries.ORACLE_SQL["op4_line_dedup"]).fetchall()
    rows = [tuple(r) for r in queries.op4_line_dedup(spark, "/root/testdata/sf0.001").select(
        "doc_id", "n_lines", "n_dropped", "text").collect()]
    assert key(rows) == key(expected) and sum(r[2] for r in rows)


def test_plan_has_no_python(spark):
    text = queries.op4_line_dedup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)
