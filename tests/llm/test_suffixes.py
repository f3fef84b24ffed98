import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartonwise.llm import suffixes, tables
from cartonwise.llm.deep_shallow import BlindTrie, _multikey_quicksort, deep_shallow
from cartonwise.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain_removal(rows, window=50):
    """Every window of every text in a dictionary."""
    def order(doc_id):
        return 2**63 - 1 if doc_id is None else doc_id

    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - window + 1):
            string = data[at:at + window]
            first[string] = min(first.get(string, 2**63), order(doc_id))
    told = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for at in range(len(data) - window + 1):
            if first[data[at:at + window]] < order(doc_id):
                gone[at:at + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        spans = [tuple(x) for x in edges.reshape(-1, 2).tolist()]
        told.append((doc_id, len(data), spans, bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])))
    return told


def as_tuples(rows):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in rows), key=str)


def corpus(seed, count=120, alphabet="ab cd\n", unit=30):
    own = random.Random(seed)
    passages = ["".join(own.choice(alphabet) for _ in range(own.randrange(10, 160))) for _ in range(12)]
    texts = []
    for _ in range(count):
        text = "".join(own.choice(passages) if own.random() < 0.5 else "".join(own.choice(alphabet) for _ in range(own.randrange(unit)))
                       for _ in range(own.randrange(8)))
        texts.append(text)
        if own.random() < 0.2:
            texts.append(text if own.random() < 0.5 else text[:len(text) // 2] + "#" + text[len(text) // 2:])
    return list(enumerate(texts))


ODD = [(500, None), (501, ""), (502, "x" * 49), (503, "x" * 50), (504, "x" * 51), (505, " " * 3000), (506, " " * 70), (507, "\x00" * 60),
       (508, "\x00" * 59 + "a"), (509, "日本語" * 40), (510, "本語日" * 30), (511, "é" * 49 + "e"), (512, "ab" * 100), (513, "ba" * 80)]


@pytest.mark.parametrize("options", [{}, {"most_contexts": 0}, {"most_contexts": 3, "bucket_bytes": 900, "together": 5},
                                     {"window": 21, "key_bytes": 4}, {"window": 9, "key_bytes": 9}])
def test_windows_of_random_texts(frame, options):
    own = random.Random(2)
    rows = [*corpus(1), *ODD, (3, "a third text of document three " * 3), (3, "a third text of document three " * 3), (None, "x" * 55),
            (None, "no id " * 20), (None, "no id " * 20), (-4, "x" * 52)]
    own.shuffle(rows)
    docs = frame(rows).withColumns({"key": F.lit(1), "doc": F.lit("x"), "row_key": F.lit(2), "spans": F.lit("y")}).repartition(7)
    got = suffixes.remove_repeats(docs, **options).collect()
    assert as_tuples(got) == sorted(plain_removal(rows, options.get("window", 50)), key=str)


def test_prose_with_edited_copies(frame, prose):
    own = random.Random(9)
    texts = [" ".join(prose(own.randrange(30, 200))) for _ in range(40)]
    for text in texts[:20]:
        words = text.split(" ")
        for _ in range(5):
            words[own.randrange(len(words))] = "edit"
        texts += [" ".join(words), " ".join(words[5:-5])]
    rows = list(zip(own.sample(range(1000), len(texts)), texts))
    assert as_tuples(suffixes.remove_repeats(frame(rows)).collect()) == sorted(plain_removal(rows), key=str)


def test_a_long_text_is_worked_through_in_slices(frame, monkeypatch):
    own = random.Random(6)
    text = "".join(own.choice("abcd ") for _ in range(30_000))
    rows = [(1, text[4000:9000]), (2, text), (3, text[::-1]), (4, "-" + text[20_000:])]
    whole = suffixes.marks(pa.array([text, text[:7000]]), 16, 50)
    monkeypatch.setattr(suffixes, "_CHUNK", 1000)
    sliced = suffixes.marks(pa.array([text, text[:7000]]), 16, 50)
    assert all(np.array_equal(a, b) for a, b in zip(whole, sliced))
    monkeypatch.undo()
    assert as_tuples(suffixes.remove_repeats(frame(rows)).collect()) == sorted(plain_removal(rows), key=str)


def test_no_texts(frame):
    assert suffixes.digests(frame([])).collect() == []
    assert [tuple(r)[:4] for r in suffixes.digests(frame([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 0, 0), (2, 0, 0, 0)]


def test_query_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in tables.documents(spark, SMALL).select("doc_id", "text").collect()]
    want = [(i, n, sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in plain_removal(rows)]
    got = QUERIES["op11_suffix_dedup"](spark, SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[2] for r in want) > 0


def matrix(strings, width):
    rows = np.zeros((len(strings), width), np.uint8)
    for row, string in zip(rows, strings):
        row[:len(string)] = np.frombuffer(string, np.uint8)
    return rows, np.array([len(s) for s in strings], np.int64)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=24), st.text(alphabet="ab\x00", max_size=24).map(str.encode)), max_size=60), st.sampled_from([0, 8, 16, 24]))
def test_order_and_common_prefixes(strings, shallow):
    rows, lengths = matrix(strings, 24)
    order, common = deep_shallow(rows, lengths, shallow)
    ordered = [strings[i] for i in order]
    assert ordered == sorted(strings)
    for at in range(1, len(ordered)):
        a, b = ordered[at - 1], ordered[at]
        assert common[at] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_quicksort_leaves_ties_of_the_shallow_depth():
    own = random.Random(1)
    strings = [bytes(own.choice(b"ab") for _ in range(8)) + bytes(own.choice(b"abc") for _ in range(8)) for _ in range(3000)]
    rows, _ = matrix(strings, 16)
    order, tied = _multikey_quicksort(rows.view(">u8").astype(np.uint64), 1)
    heads = [strings[i][:8] for i in order]
    assert heads == sorted(heads)
    assert tied == [(heads.index(h), heads.index(h) + heads.count(h)) for h in sorted(set(heads)) if heads.count(h) > 1]


def test_blind_trie_orders_what_it_holds():
    own = random.Random(3)
    strings = [bytes(own.choice(b"ab") for _ in range(12)) for _ in range(500)]
    trie = BlindTrie()
    for name, string in enumerate(strings):
        trie.insert(string, name)
    leaves = list(trie.leaves())
    assert [strings[names[0]] for names in leaves] == sorted(set(strings))
    assert all(len({strings[n] for n in names}) == 1 for names in leaves) and sum(map(len, leaves)) == 500
