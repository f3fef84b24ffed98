import random

import numpy as np
import pyarrow as pa

from cartonwise.llm.text_arrays import Words, shingle_hashes, texts_of


def words_of(texts, lower=True, most_bytes=1 << 21):
    found = []
    for first, end, data, offsets in texts_of(pa.array(texts, pa.string()), most_bytes):
        words = Words(data, offsets, lower)
        hashes = words.hashes() if len(data) else np.zeros(0, np.uint64)
        found += [hashes[words.first[i]:words.first[i + 1]].tolist() for i in range(end - first)]
    return found


def test_words_are_those_of_ascii_white_space():
    own = random.Random(1)
    alphabet = ["a", "B", "é", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\u00a0", "\u3000", "日"]
    texts = ["".join(own.choices(alphabet, k=own.randint(0, 40))) for _ in range(300)] + [None, "", " ", "x" * 5000]
    expected = [(t or "").encode().lower().split() for t in texts]
    for most in (1 << 21, 64):
        found = words_of(texts, most_bytes=most)
        assert [len(f) for f in found] == [len(e) for e in expected]
        names = {}
        for hashes, words in zip(found, expected):
            for h, w in zip(hashes, words):
                assert names.setdefault(w, h) == h  # the same word, the same hash, wherever it stands
        assert len(set(names.values())) == len(names)


def test_case_counts_only_if_asked():
    assert words_of(["Ab aB"], lower=True)[0][0] == words_of(["Ab aB"], lower=True)[0][1]
    assert len(set(words_of(["Ab aB"], lower=False)[0])) == 2


def test_sliced_columns_and_shingles():
    column = pa.array(["a b", "c d e", None, "f"], pa.string()).slice(1, 3)
    assert [(f, e, d.tobytes()) for f, e, d, _ in texts_of(column)] == [(0, 3, b"c d ef")]
    hashes = np.arange(7, dtype=np.uint64)
    assert len(shingle_hashes(hashes, 5)) == 3 and len(shingle_hashes(hashes[:4], 5)) == 0
    assert shingle_hashes(hashes, 5)[1] == shingle_hashes(hashes[1:], 5)[0]
