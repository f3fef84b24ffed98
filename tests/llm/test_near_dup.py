import random

import numpy as np
import pytest

from cartonwise.llm import components, near_dup, queries, tables


def shingles(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(docs):
    """Every pair."""
    sets = {i: shingles(t) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    by_token = {}
    for i in ids:
        for token in sets[i]:
            by_token.setdefault(token, []).append(i)
    pairs = {(a, b) for group in by_token.values() for a in group for b in group if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            ends = sorted((find(a), find(b)))
            root[ends[1]] = ends[0]
    return {i: (len(sets[i]), find(i)) for i in ids}


def linked(docs_frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.link(docs_frame).collect() if r.doc_id is not None}


def changed(words, count, own):
    words = list(words)
    for place in own.sample(range(len(words)), count):
        words[place] = f"new{own.random()}"
    return words


@pytest.fixture(scope="module")
def family():
    """Copies of copies with one to six words of 120 changed, and unrelated texts with a common passage."""
    own = random.Random(9)
    words = [f"w{own.randrange(5000)}" for _ in range(120)]
    docs, members = [], [words]
    for i in range(260):
        members.append(changed(own.choice(members[:40]), own.randint(1, 6), own))
        docs.append((i, " ".join(members[-1])))
    for i in range(300, 420):
        docs.append((i, " ".join(words[:40] + [f"u{own.random()}" for _ in range(own.randint(10, 120))])))
    docs += [(500, docs[0][1].upper()), (501, docs[0][1].replace(" ", "\n")), (502, "a b c"), (503, "A  B c"), (504, "a b"), (505, None), (506, "  ")]
    return docs


def test_against_every_pair(frame, family):
    assert linked(frame(family)) == plain(family)


def test_small_leaves_blocks_and_sides_do_not_change_links(frame, family, monkeypatch):
    for name, value in (("_LEAF", 4), ("_SIDE", 8), ("_BLOCK", 8), ("_DEPTH", 3)):
        monkeypatch.setattr(near_dup, name, value)
    assert linked(frame(family)) == plain(family)


def meet(rows):
    pairs = rows.alias("a").join(rows.alias("b"), "node").where("a.doc < b.doc").select("a.doc", "b.doc").distinct()
    return {tuple(r) for r in pairs.collect()}


def test_blocks_let_all_meet_and_sides_all_that_matter(frame, monkeypatch):
    monkeypatch.setattr(near_dup, "_SIDE", 16)
    rows = frame([(7, i, 0 if i < 95 else i) for i in range(100)], "node long, doc long, comp long")
    assert meet(near_dup._blocks(rows, frame([(7, 100)], "node long, n long"))) == {(a, b) for a in range(100) for b in range(a + 1, 100)}
    sided = near_dup._one_sided(rows, frame([(7, 100, 0, 5)], "node long, n long, major long, others long"))
    assert meet(sided) >= {(a, b) for a in range(100) for b in range(a + 1, 100) if b >= 95}
    assert sided.groupBy("node").count().agg({"count": "max"}).first()[0] < 40


def test_exact_similarities():
    own = np.random.default_rng(1)
    sets = [np.unique(own.integers(0, 60, own.integers(1, 50)).astype(np.uint64)) for _ in range(60)]
    expected = [[i, j] for i in range(60) for j in range(i + 1, 60)
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 40 * len(np.union1d(sets[i], sets[j]))]
    assert near_dup._similar(sets, 40).tolist() == expected and expected


def test_profiles_estimate_similarity():
    own = np.random.default_rng(2)
    base = own.integers(0, 2**63, 400, dtype=np.uint64)
    for share in (0.2, 0.5, 0.75, 0.9):
        other = np.concatenate([base[:int(400 * share)], own.integers(0, 2**63, 400 - int(400 * share), dtype=np.uint64)])
        true = len(np.intersect1d(base, other)) / len(np.union1d(base, other))
        one, two = (np.frombuffer(near_dup.profile(np.unique(x)), np.uint8) for x in (base, other))
        assert abs(near_dup._alike(one, two) - true) < 0.12


def test_odd_rows(frame):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [(3, long), (2, long), (2, long), (None, long), (5, ""), (6, None), (7, "one two three four five"), (7, "six seven eight nine ten"),
            (8, "six seven eight nine ten"), (9, "ONE two three four five")]
    rows = near_dup.link(frame(docs).selectExpr("*", "'r' as rep", "1 as component", "2 as signature", "3 as doc")).collect()
    assert len(rows) == len(docs)
    found = sorted({(r.doc_id or 0, r.component_id or 0, r.kept, r.n_shingles) for r in rows})
    assert found == [(0, 0, True, 59_996), (2, 2, True, 59_996), (3, 2, False, 59_996), (5, 5, True, 0), (6, 6, True, 0), (7, 7, True, 1),
                     (8, 7, False, 1), (9, 7, False, 1)]
    assert near_dup.link(frame([])).count() == 0
    assert linked(frame([(1, "only one text here now")])) == {1: (1, 1)}


def test_components(frame):
    own = random.Random(3)
    edges = [(i, i + 1) for i in range(300)] + [(own.randrange(1000, 1400), own.randrange(1000, 1400)) for _ in range(250)] + [(2000, 2000 + i) for i in range(1, 200)]
    edges += [(5, 5), (None, 1), edges[0]]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for u, v in edges:
        if u is not None and u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    found = {r.vertex: r.component for r in components.components(frame(edges, "u long, v long")).collect()}
    by_rounds = components.components(frame(edges, "u long, v long"), in_one_task=0).collect()
    assert found == {r.vertex: r.component for r in by_rounds} and len(found) == len(by_rounds)
    assert found == {i: find(i) for i in root}
    assert components.components(frame([], "u long, v long")).count() == 0


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in tables.documents(spark, "/root/testdata/sf0.01").collect()]
    rows = queries.op6_near_duplicates(spark, "/root/testdata/sf0.01").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(docs) and len(rows) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows) and any(not r.kept for r in rows)
