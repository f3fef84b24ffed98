import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cartonwise.llm import alignment, queries, tables
from cartonwise.llm.ranks import Ranks, byte_alphabet

A, B = public_tokenizers.path(queries.VOCABULARY), public_tokenizers.path(queries.PIECES)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_alignment(libraries, rows):
    """Every pair of tokens of every text compared, with the libraries themselves."""
    a, b = libraries
    alphabet = byte_alphabet()
    links, told = [], []
    for doc_id, text in rows:
        if not text:
            told.append((doc_id, 0, 0, 0, ""))
            links.append([])
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            told.append((doc_id, 0, 0, 0, ""))
            links.append([])
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        own = []
        for j, (eb, y) in enumerate(zip(ends_b, bytes_b)):
            i = 0 if j == 0 else bisect_left(ends_a, ends_b[j - 1] + 1)
            while i < len(ends_a) and ends_a[i] - len(bytes_a[i]) < eb:
                own.append((ids_a[i], ids_b[j]))
                i += 1
        groups, sa, sb = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            ea, eb = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, ids_a[sa:ea])) + "|" + ",".join(map(str, ids_b[sb:eb])))
            sa, sb = ea, eb
        told.append((doc_id, len(ids_a), len(ids_b), len(groups), ";".join(groups)))
        links.append(own)
    counts = Counter(pair for own in links for pair in own)
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(i, na, nb, ng, len(own), sum(counts[p] == most[p[1]] for p in own), sum(counts[p] for p in own),
             hashlib.sha256(g.encode()).hexdigest() if g else "", g) for (i, na, nb, ng, g), own in zip(told, links)]


PIECES = [" ", "  ", "   ", "\n", "\t", "a", "The", " the", "é", "日本", "🙂", "<s>", "<0x41>", "<|endoftext|>", "'s", "123", "\x00", "ﬁ", "ａ", "́",
          "supercalifragilistic", "=====", "　", " "]


def test_rows(spark, frame, libraries):
    own = random.Random(11)
    texts = [None, "", " ", "\n", "▁", "a▁b", "  two  ", "x" * 300, "<unk><s></s>"]
    texts += ["".join(own.choice(PIECES) for _ in range(own.randrange(80))) for _ in range(300)]
    rows = [*enumerate(texts), (12, "again and again"), (12, "again and again"), (None, "no id"), (-5, "the the the")]
    docs = frame(rows).withColumns({"n_a": F.lit(1), "block": F.lit(2), "pair": F.lit("x"), "docs": F.lit("y")}).repartition(5)
    for block_bytes in (200, 2 << 20):
        got = alignment.align(docs, A, B, block_bytes=block_bytes).collect()
        assert sorted(map(tuple, got), key=str) == sorted(plain_alignment(libraries, rows), key=str)


def test_no_texts(frame):
    assert alignment.align(frame([]), A, B).collect() == []
    assert [tuple(r) for r in alignment.align(frame([(1, None), (2, "")]), A, B, with_groups=False).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_whole_table(spark, libraries):
    rows = [(r.doc_id, r.text) for r in tables.documents(spark, SMALL).select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_token_alignment"](spark, SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(r[:-1] for r in plain_alignment(libraries, rows))


@pytest.mark.parametrize("text", ["word " * 400_000, "x" * 1_000_000, " " * 1_000_000, "a" + "\n" * 500_000 + "b"])
def test_long_texts(frame, text):
    row = alignment.align(frame([(1, text)]), A, B, with_groups=False).first()
    assert row.n_a > 0 and row.n_b > 0 and row.n_links == row.n_a + row.n_b - row.n_groups


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 400), unique=True), st.lists(st.integers(0, 400), unique=True), st.integers(-3, 500))
def test_gallop_finds_every_rank(short, long, start):
    short, long = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    assert alignment.gallop(short, long, np.full(len(short), start)).tolist() == np.searchsorted(long, short).tolist()


def test_a_full_store_changes_no_token(libraries):
    own = random.Random(4)
    side = alignment.PieceSide(B, store=7)
    for _ in range(60):
        texts = ["".join(own.choice(PIECES) for _ in range(own.randrange(30))) for _ in range(3)]
        assert [ids.tolist() for ids in side.encode(texts)] == [libraries[1].encode(t) for t in texts]


def test_long_white_space_is_the_library_s(libraries):
    ranks, own = Ranks(A), random.Random(8)
    for _ in range(40):
        text = "".join(own.choice(["x", "\n" * 999, " " * 1000, "\t 　" * 700, "\x85" * 1001, "12", "\x1c" * 1200, "'s"]) for _ in range(6))
        assert ranks.encode(text) == libraries[0].encode(text, add_special_tokens=False).ids
