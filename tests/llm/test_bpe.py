import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cartonwise.llm import bpe, queries, tables

PATH = public_tokenizers.path(queries.VOCABULARY)
PIECES = [" ", "  ", "\n", "\t", "a", "Z", "é", "'", "'s", "'re", "1", "23", "!", "<|endoftext|>", "<|endof", "\u00a0", "\u3000", "日本", "🙂",
          "ñ", "\u0301", "don't", "\x85", "\u200b", "A" * 50, " " * 30, "\r\n", "=", "==="]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("mean, least", [(16, 4), (64, 1), (1024, 256)])
def test_ids_and_text_are_the_library_s(library, mean, least):
    own = random.Random(mean)
    encoder = bpe.Encoder(PATH, mean, least)
    for _ in range(400):
        text = "".join(own.choice(PIECES) for _ in range(own.randint(0, 150)))
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_a_shared_passage_is_encoded_once():
    own = random.Random(5)
    passage = " ".join("".join(own.choices("abcdefg", k=6)) for _ in range(2000))
    encoder = bpe.Encoder(PATH, 256, 64)
    calls = []
    plain = encoder._plain
    encoder._plain = lambda data: calls.append(len(data)) or plain(data)
    encoder.encode(passage)
    first = sum(calls)
    calls.clear()
    encoder.encode("A different beginning, then: " + passage)
    assert sum(calls) < first / 3


def test_rows(spark, frame, library):
    long = "word " * 60_000
    docs = frame([(1, "Hello <|endoftext|> you"), (2, None), (3, ""), (4, long), (4, long), (None, "x")]).selectExpr(
        "doc_id", "text", "'other' as n_tokens", "1 as ids")
    rows = sorted(bpe.encode(docs, PATH).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    texts = ["Hello <|endoftext|> you", "", "", long, long, "x"]
    for row, text in zip(rows, texts):
        ids = library.encode(text, add_special_tokens=False).ids
        assert (row.ids, row.n_tokens) == (ids, len(ids))
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert back == {1: texts[0], 2: "", 3: "", 4: long, None: "x"}
    assert bpe.encode(frame([]), PATH).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in tables.documents(spark, "/root/testdata/sf0.001").collect()}
    rows = queries.op9_bpe_round_trip(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()
