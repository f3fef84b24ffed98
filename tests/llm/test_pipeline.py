import re

import corpus_pipeline
import pytest

from cartonwise.llm import language, tables

FOLDER = "/root/testdata/sf0.001"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows before the first stage and after each."""
    docs = tables.documents(spark, FOLDER)
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, found[-1], FOLDER).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_return_documents(stages):
    assert NAMES == ["language", "lines", "near_duplicates", "leaks", "tokens"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1]) and stages[-1].columns[0] == "doc_id"


def test_language_keeps_documents_with_a_language(stages):
    before, after = rows(stages[0]), rows(stages[1])
    assert len(after) >= 0.97 * len(before) and all(before[i] == r for i, r in after.items())
    judged = {r.doc_id: (r.lang_pred != "und" and r.score >= 0.4) for r in language.identify(stages[0]).collect()}
    assert set(after) == {i for i, kept in judged.items() if kept}


def test_lines_drops_later_copies(stages):
    from test_lines import plain

    before, after = rows(stages[1]), rows(stages[2])
    expected = {i: text for i, _, dropped, text in plain([(i, r.text) for i, r in before.items()]) if not dropped or text.strip()}
    assert {i: r.text for i, r in after.items()} == expected
    assert all(r.n_chars == len(r.text) and (r.lang, r.source) == (before[i].lang, before[i].source) for i, r in after.items())


def test_one_of_each_group_stays(stages):
    from test_near_dup import plain

    before, after = rows(stages[2]), rows(stages[3])
    assert set(after) == {i for i, (_, component) in plain([(i, r.text) for i, r in before.items()]).items() if i == component}


def test_leaks_go(spark, stages):
    before, after = rows(stages[3]), rows(stages[4])
    items = [r.text for r in tables.read(spark, FOLDER, "benchmark").collect()]
    exact = {i for i, r in before.items() if any(t in r.text for t in items)}
    assert not exact & set(after) and len(before) - len(after) <= 2 * len(exact) + 1


def test_tokens_are_of_what_is_left(stages):
    import hashlib

    before, after = rows(stages[4]), rows(stages[5])
    assert set(before) == set(after)
    assert all(r.decoded_sha256 == hashlib.sha256(before[i].text.encode()).hexdigest() and len(r.ids) == r.n_tokens for i, r in after.items())


def test_run(spark, stages):
    assert rows(corpus_pipeline.run(spark, FOLDER)) == rows(stages[-1])


def test_stages_on_odd_documents(spark, frame):
    docs = frame([(None, None, None, None, None), (None, "Some words that mean nothing here", "en", "s", 33), (1, "", "en", None, 0), (2, None, None, None, None),
                  (3, "Some words that mean nothing here", "en", "s", 33), (3, "Some words that mean nothing here", "en", "s", 33),
                  (4, "word " * 40_000, "en", "s", 200_000)], "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 as row", "'d' as dropped", "2 as `a.b`")
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, table, FOLDER)
            assert found.columns == table.columns
            kept = found.collect()
            assert len(kept) <= table.count() and (table is not docs or any(r.doc_id == 3 for r in kept)), name
        assert corpus_pipeline.STAGES[-1][1](spark, table, FOLDER).count() == table.count()


def test_plans_have_no_cross_join(spark):
    for name, stage in corpus_pipeline.STAGES:
        text = stage(spark, tables.documents(spark, FOLDER), FOLDER)._jdf.queryExecution().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name
