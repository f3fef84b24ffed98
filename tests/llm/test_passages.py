import random

import numpy as np

from cartonwise.llm import passages, queries, tables


def best_chain_score(x, y):
    """Every predecessor tried."""
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    score = {}
    for i in order:
        score[i] = max([float(passages.SEED_WORDS)] + [
            passages.SEED_WORDS + score[j] - passages._GAP_COST * (x[i] - x[j] + y[i] - y[j] - 2 * passages.SEED_WORDS)
            for j in score if x[j] < x[i] and y[j] < y[i]
            if score[j] - passages._GAP_COST * (x[i] - x[j] + y[i] - y[j] - 2 * passages.SEED_WORDS) > 0])
    return max(score.values())


def chain_score(x, y, own):
    return passages.SEED_WORDS * len(own) - passages._GAP_COST * sum(
        x[b] - x[a] + y[b] - y[a] - 2 * passages.SEED_WORDS for a, b in zip(own, own[1:]))


def test_the_first_chain_is_the_best():
    own = random.Random(1)
    for _ in range(300):
        points = sorted({(own.randrange(120), own.randrange(120)) for _ in range(own.randint(2, 40))})
        x, y = [p[0] for p in points], [p[1] for p in points]
        chains = passages.chain(x, y)
        for c in chains:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))
        assert len({k for c in chains for k in c}) == sum(map(len, chains))
        best = best_chain_score(x, y)
        if best > passages.SEED_WORDS:
            assert abs(chain_score(x, y, chains[0]) - best) < 1e-6


def test_every_stretch_has_a_seed():
    own = np.random.default_rng(2)
    words = own.integers(0, 2**63, 500, dtype=np.uint64)
    _, places = passages.seeds(words)
    assert np.diff(places).max() <= passages.SEED_WINDOW and places[0] < passages.SEED_WINDOW
    hashes, _ = passages.seeds(words[100:200])
    assert set(hashes) <= set(passages.seeds(words)[0]) | set(hashes[:8]) | set(hashes[-8:])
    assert len(passages.seeds(np.full(20_000, 5, np.uint64))[0]) == 1 and len(passages.seeds(words[:4])[0]) == 0


def test_growing_stops_where_texts_differ():
    a, b = np.array([1, 2, 3, 9, 5, 6, 70, 80, 90]), np.array([1, 2, 3, 4, 5, 6, 7, 8, 9])
    assert passages._grown(a, b) == (6, 6, 5)
    assert passages._grown(np.array([1, 2, 3]), np.array([1, 9, 2, 3, 4])) in ((3, 4, 3), (1, 1, 1))
    assert passages._grown(np.array([1]), np.array([2])) == (0, 0, 0)
    own = random.Random(3)
    for _ in range(300):  # every row of the alignment
        a, b = ([own.randrange(own.choice((4, 30))) for _ in range(own.randint(1, 30))] for _ in range(2))
        score = {(i, j): -max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                score[i, j] = max(score[i - 1, j] - 1, score[i, j - 1] - 1, score[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -1))
        i, j, agreeing = passages._grown(np.array(a), np.array(b))
        assert score[i, j] == max(score.values()) and agreeing <= min(i, j)


def rows_of(docs_frame):
    return [tuple(r) for r in passages.repeated_passages(docs_frame).select(
        "doc_id", "source_doc_id", "kind", "start_word", "end_word", "source_start", "source_end").collect()]


def test_planted_passages_are_found_to_the_word(frame, prose):
    passage, other = prose(70), prose(60)
    fuzzy = list(other)
    for place in (9, 23, 37, 51):
        fuzzy[place] = "changed"
    del fuzzy[30]
    docs = {1: prose(100) + passage + prose(50), 2: passage + prose(200), 3: prose(33) + passage, 4: prose(300) + other + prose(10),
            5: prose(10) + fuzzy + prose(10), 6: prose(500), 7: prose(44), 8: passage[:30] + prose(100)}
    found = sorted(rows_of(frame([(i, " ".join(w)) for i, w in docs.items()])))
    assert found == [(2, 1, "passage", 0, 70, 100, 170), (3, 1, "passage", 33, 103, 100, 170), (5, 4, "passage", 10, 69, 300, 360)]


def test_many_copies_make_few_rows(frame, prose):
    passage, whole = prose(55), " ".join(prose(80))
    docs = [(i, " ".join(prose(20) + passage + prose(20))) for i in range(300)] + [(1000 + i, whole) for i in range(200)]
    found = rows_of(frame(docs))
    assert {r[0] for r in found if r[2] == "passage"} == set(range(1, 300)) and len(found) == 299 + 199
    assert {(r[1], r[3], r[4]) for r in found if r[2] == "copy"} == {(1000, 0, 80)}


def test_odd_rows(frame, prose):
    long, passage = prose(60_000), prose(60)
    docs = [(1, None), (2, ""), (None, " ".join(passage)), (3, "junk " * 50_000), (4, "junk " * 40_000), (5, " ".join(long + passage)),
            (6, " ".join(passage)), (6, " ".join(passage)), (7, " ".join(passage + passage))]
    table = frame(docs).selectExpr("*", "'d' as doc", "1 as source", "2 as h")
    found = set(rows_of(table))
    assert (6, 5, "passage", 0, 60, 60_000, 60_060) in found
    assert {r[0] for r in found} == {6, 7} and all(r[1] == 5 for r in found)
    assert rows_of(frame([])) == []


def test_query(spark):
    """Words that stand in a row in two documents, by plain Python: each such stretch is found, and nothing that isn't one."""
    docs = {r.doc_id: r.text.lower().split() for r in tables.documents(spark, "/root/testdata/sf0.001").collect()}
    rows = queries.op5_substring_dedup(spark, "/root/testdata/sf0.001").collect()
    first = {}
    for i in sorted(docs):
        for k in range(len(docs[i]) - 59):
            first.setdefault(tuple(docs[i][k:k + 60]), i)
    expected = {i for i in docs for k in range(len(docs[i]) - 59) if first[tuple(docs[i][k:k + 60])] != i}
    assert expected and expected <= {r.doc_id for r in rows}
    for row in rows:
        one, two = docs[row.doc_id][row.start_word:row.end_word], docs[row.source_doc_id][row.source_start:row.source_end]
        assert min(len(one), len(two)) >= 45 and len(set(one) & set(two)) >= 0.6 * len(set(one))


def test_passages_with_words_changed_at_random_places(frame, prose):
    own, docs, expected = random.Random(11), {}, set()
    for i in range(60):
        passage = prose(60)
        changed = list(passage)
        for place in own.sample(range(60), 6 + 3 * (i % 3)):  # 10, 15 and 20 %
            changed[place] = "changed"
        docs[i], docs[1000 + i] = prose(40) + passage + prose(40), prose(30) + changed + prose(30)
        expected.add((1000 + i, i))
    found = {r[:2] for r in rows_of(frame([(i, " ".join(w)) for i, w in docs.items()]))}
    assert found <= expected and len(found) >= 58


def test_thinned_links_keep_ends_and_breaks():
    x, y = np.array([0, 2, 4, 4, 6, 9, 40, 42, 43]), np.array([5, 7, 9, 9, 11, 14, 90, 92, 95])
    assert [p.tolist() for p in passages.thinned(x, y)] == [[0, 9, 40, 42, 43], [5, 14, 90, 92, 95]]
    long = np.arange(0, 400, 3)
    kept, other = passages.thinned(long, long + 7)
    assert kept[0] == 0 and kept[-1] == long[-1] and np.diff(kept).max() <= 12 and (other - kept == 7).all()


def test_a_passage_whose_parts_stand_in_earlier_documents(frame, prose):
    passage, long = prose(50), prose(120)
    docs = {1: prose(60) + passage[:25] + prose(40), 2: prose(30) + passage[25:] + prose(60), 3: prose(20) + passage + prose(30),
            4: prose(70) + passage + prose(10)}
    docs |= {10 + k: prose(25) + long[20 * k:20 * k + 20] + prose(25) for k in range(6)}
    docs |= {20: prose(15) + long + prose(15), 21: long + prose(40)}
    found = rows_of(frame([(i, " ".join(w)) for i, w in docs.items()]))
    assert sorted(found) == [(4, 3, "passage", 70, 120, 20, 70), (21, 20, "passage", 0, 120, 15, 135)]


def test_contexts_stand_for_their_words():
    own = np.random.default_rng(4)
    shared = own.integers(0, 2**63, 45, dtype=np.uint64)
    for _ in range(200):
        one, two = (np.concatenate([own.integers(0, 2**63, n, dtype=np.uint64), shared, own.integers(0, 2**63, 30, dtype=np.uint64)])
                    for n in own.integers(0, 60, 2))
        keys = []
        for text in (one, two):
            hashes, places = passages.seeds(text)
            starts, found, last = passages.contexts(np.zeros(len(places), np.int64), places, hashes, 36)
            keys.append({h: text[places[s]:places[e] + passages.SEED_WORDS].tolist() for s, h, e in zip(starts, found.tolist(), last)})
        common = set(keys[0]) & set(keys[1])
        assert common and all(keys[0][h] == keys[1][h] for h in common)


def test_a_passage_whose_long_pieces_stand_in_earlier_documents(frame, prose):
    """Pieces of up to 44 words, too short for a passage, in earlier documents: the document that has the whole is found."""
    exact, long, own = prose(45), prose(150), random.Random(5)
    docs = {1: prose(60) + exact[:42] + prose(40), 2: prose(30) + exact[4:] + prose(60), 3: prose(20) + exact + prose(30),
            4: prose(70) + exact + prose(10)}
    docs |= {10 + k: prose(25) + long[15 * k:15 * k + 44] + prose(25) for k in range(8)}
    docs |= {20: prose(15) + long + prose(15), 21: long + prose(40)}
    expected = {(4, 3), (21, 20)}
    for i in range(30):
        passage = prose(own.randint(45, 70))
        for k in range(own.randint(2, 5)):
            size = own.randint(18, 44)
            at = own.randrange(len(passage) - size + 1)
            docs[100 + 10 * i + k] = prose(20) + passage[at:at + size] + prose(20)
        docs[100 + 10 * i + 8], docs[100 + 10 * i + 9] = prose(own.randint(0, 30)) + passage + prose(9), prose(own.randint(0, 30)) + passage + prose(7)
        expected.add((109 + 10 * i, 108 + 10 * i))
    found = rows_of(frame([(i, " ".join(w)) for i, w in docs.items()]))
    assert {r[:2] for r in found} == expected
    assert {(4, 3, "passage", 70, 115, 20, 65), (21, 20, "passage", 0, 150, 15, 165)} <= set(found)


def test_spans_left_open():
    pos = np.arange(0, 100, 4)
    one, two = np.zeros(25, np.int64), np.where(pos < 52, 1, 2)
    spans = lambda source, y: [tuple(int(v) for v in s) for s in zip(*passages.open_spans(np.full(25, 7), pos, source, y, 45))]
    assert spans(one, pos + 9) == [(7, 57, 104)]  # one run, 0:101, and the three words behind it
    assert spans(two, pos) == [(7, 9, 96), (7, 57, 104)]  # 0:53 and 52:101
    assert spans(one, np.where(pos < 20, pos, pos + 1)) == [(7, 0, 64), (7, 57, 104)]
    assert spans(np.arange(25), pos) == [(7, 0, 104)]
    assert passages.open_spans(pos[:9] * 0, pos[:9], one[:9], pos[:9], 45)[0].tolist() == []


def test_seeds_of_many_texts_are_those_of_each():
    own = np.random.default_rng(6)
    for least in (1, 6, 45):
        texts = [own.integers(0, own.choice((2, 40, 2**63)), n, dtype=np.uint64) for n in [*own.integers(0, 12, 40), *own.integers(30, 90, 20)]]
        own.shuffle(ends := [len(t) for t in texts])
        words, first = np.concatenate(texts), np.concatenate([[0], np.cumsum(ends)])
        got = sorted(zip(*(c.tolist() for c in passages.seeds_of(words, first, least))))
        each = [(passages.seeds(words[a:b]), i) for i, (a, b) in enumerate(zip(first[:-1], first[1:])) if b - a >= least]
        assert got == sorted((h, i, place) for (hashes, places), i in each for h, place in zip(hashes.tolist(), places.tolist()))
    assert all(len(c) == 0 for c in passages.seeds_of(np.zeros(0, np.uint64), np.zeros(3, np.int64), 1))


def test_passages_grow_together_as_each_alone():
    own, pairs = random.Random(7), [(np.array([], np.uint32), np.array([], np.uint32))]
    for _ in range(1200):  # more than grow at once
        words = own.choice((2, 4, 30))
        one = [own.randrange(words) for _ in range(own.randint(0, 48))]
        two = [w if own.random() < 0.8 else 99 for w in one][own.randint(0, 2):] if own.random() < 0.5 else [own.randrange(words) for _ in range(own.randint(0, 48))]
        pairs.append((np.array(one, np.uint32), np.array(two, np.uint32)))
    together = passages._all_grown(pairs)
    assert together == [passages._grown(a, b) for a, b in pairs]
    assert passages._all_grown([]) == [] and together[0] == (0, 0, 0)
    rows = []
    together = passages._grown_together
    try:
        passages._grown_together = lambda some: rows.append(len(some)) or together(some)
        passages._all_grown(pairs)
    finally:
        passages._grown_together = together
    assert rows == [512, 512, 177]
