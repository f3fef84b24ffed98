import numpy as np

from cartonwise.llm import language, queries, tables

RNG = np.random.default_rng(0)


def test_gradients_lower_the_loss_and_tables_equal_a_plain_convolution():
    texts = [b"the cat and the dog", b"el gato y el perro", b"der hund und die katze"] * 20
    windows = np.zeros((60, 64 + 3), np.uint8)
    for row, text in zip(windows, texts):
        row[:len(text)] = np.frombuffer(text, np.uint8)
    labels = np.array([0, 1, 2] * 20)
    network = language.train(windows, labels, ("en", "es", "de"), epochs=20)
    assert (network.probabilities(windows).argmax(1) == labels).all()
    plain = np.zeros((64, network.tables.shape[2]))
    for t in range(64):
        plain[t] = sum(network.tables[p][windows[0][t + p]] for p in range(4))
    logits = np.maximum(plain.max(0) + network.bias, 0) @ network.dense + network.dense_bias
    expected = np.exp(logits - logits.max())
    assert np.allclose(network.probabilities(windows[:1])[0], expected / expected.sum(), atol=1e-5)


def test_gradient_against_differences():
    """One step's change of the dense weights has the sign of the numeric gradient."""
    windows, labels = RNG.integers(97, 123, (32, 20 + 3)).astype(np.uint8), RNG.integers(0, 2, 32)

    def loss(network):
        return -np.log(network.probabilities(windows)[np.arange(32), labels]).mean()

    losses = [loss(language.train(windows, labels, ("a", "b"), epochs=n, rate=0.003, seed=1)) for n in (1, 10, 40)]
    assert losses[0] > losses[1] > losses[2]


def test_windows_cover_a_text():
    data = np.frombuffer(b"ABCDEFGHIJ", np.uint8)
    found = language.windows_of(data, np.array([0, 4, 8]), np.array([10, 10, 10]), 4)
    assert [f[:4].tobytes() for f in found] == [b"abcd", b"efgh", b"ij\0\0"] and not found[:, 4:].any()


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r.lang for r in tables.documents(spark, "/root/testdata/sf0.01").collect()}
    rows = queries.op8_language_id(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    held = [r for r in rows if r.held_out]
    assert 100 < len(held) < 300 and sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, frame):
    english, german = "the quick brown fox jumps over the lazy dog and runs", "der schnelle braune Fuchs springt über den faulen Hund"
    docs = [(i, (english, german)[i % 2], ("en", "de")[i % 2]) for i in range(60)]
    docs += [(100, None, "en"), (101, "", "de"), (102, "12 34 !?", "en"), (103, "日本", None), (104, english * 20_000, None), (104, english * 20_000, None),
             (None, german, "de")]
    table = frame(docs, "doc_id long, text string, lang string").selectExpr("*", "'x' as lang_pred", "1 as score", "2 as window")
    found = [(r.doc_id, r.lang_pred) for r in language.identify(table).collect()]
    assert len(found) == len(docs)
    assert {(100, "und"), (101, "und"), (102, "und"), (104, "en"), (None, "de")} <= set(found) and (103, "und") not in found
    assert all(lang == ("en", "de")[i % 2] for i, lang in found if i is not None and i < 60)
    assert language.learn(table.where("false")) is None and language.identify(table.where("false")).count() == 0
    assert {r.lang_pred for r in language.identify(table.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
    kept = language.accepted(table, language.learn(table))
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} >= {0, 1, 104, None}
    assert not {100, 101, 102} & {r.doc_id for r in kept.collect()}
    assert language.accepted(table, None).count() == len(docs)


def test_labels_of_held_out_rows_teach_nothing(spark, frame):
    table = frame([(i, "some words here", "en") for i in range(50)], "doc_id long, text string, lang string")
    marked = table.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 'zz' else lang end as lang")
    assert marked.where("lang = 'zz'").count() and language.learn(marked).languages == ("en",)
