"""A load may stop anywhere: repeated, it must give what it would have given at once."""

import shutil

import pytest
from line_rows import MAY, rows_of
from test_loading import BASE, write

import cartonwise.sources.store as store_module
from cartonwise.functions.dates import shift_month
from cartonwise.jobs import Home
from cartonwise.operators.facts import rollup
from cartonwise.sources.journal import Journal
from cartonwise.sources.store import LineStore, Published

APRIL, MARCH = shift_month(MAY, -1), shift_month(MAY, -2)


def lines(month, days, supplier="ACME"):
    return [BASE | {"Current Handover Date": f"{month:%Y-%m}-{d:02d}" if d else "", "Kimball": str(d), "Supplier": supplier} for d in days]


class Stop(Exception):
    pass


def state(home):
    published = rows_of(home.published.lines, "source_file", "handover_month", "kimball", "supplier")
    contents = rows_of(home.published.contents, "source_file", "supplier", "month", "lines")
    totals = rows_of(home.published.rollup.select("month", "supplier", "lines", "compliant"))
    assert totals == rows_of(rollup(home.published.lines.drop("handover_month", "approved_by")).select("month", "supplier", "lines", "compliant"))
    return published, rows_of(home.published.firsts), contents, home.journal.unfinished()


def files(tmp_path, second):
    """Two loaded exports, and the paths of the load that stops: one of them again, and a new one."""
    one = write(tmp_path / "in" / "one.csv", lines(MARCH, [1, 2]) + lines(APRIL, [3], "Early"))
    two = write(tmp_path / "in" / "two.csv", lines(APRIL, [4, 5]) + lines(MAY, [6, 0]))
    if second:
        write(tmp_path / "in" / "one.csv", lines(APRIL, [7], "Early") + lines(MAY, [8], "Late"))
        write(tmp_path / "in" / "three.csv", lines(APRIL, [9]) + lines(MAY, [10, 11]))
        return [one, str(tmp_path / "in" / "three.csv")]
    return [one, two]


def breaks(monkeypatch, spark, home):
    """Steps of a load by name, each made to stop there, some with what a stopped write leaves behind."""
    def stops(owner, name, first=None, after=False):
        whole = getattr(owner, name)

        def stopped(*args, **kwargs):
            if first:
                first(*args)
            if after:
                whole(*args, **kwargs)
            raise Stop(name)

        monkeypatch.setattr(owner, name, stopped)

    def gone(folder):
        def remove(*_):
            for path in (home.path + "/" + folder,):
                shutil.rmtree(path)
        return remove

    return {
        "entered": lambda: stops(Journal, "begin", after=True),
        "a file's old rows deleted": lambda: stops(LineStore, "_write", first=gone("lines/source_file=one.csv")),
        "stored": lambda: stops(LineStore, "_write", after=True),
        "reported": lambda: stops(Published, "publish_files"),
        "a month deleted": lambda: stops(store_module, "publish", first=gone("published/lines/handover_month=2026-04-01")),
        "a rollup month deleted": lambda: stops(store_module, "publish_rollup", first=gone("published/rollup/month=2026-04-01")),
        "months written": lambda: stops(store_module, "publish", after=True),
        "first months deleted": lambda: stops(Published, "_publish_firsts", first=gone("published/first_months")),
        "first months written": lambda: stops(Published, "_publish_firsts", after=True),
        "contents deleted": lambda: stops(Journal, "finish", first=gone("published/contents/source_file=one.csv")),
        "published": lambda: stops(Journal, "finish"),
    }


STEPS = ["entered", "a file's old rows deleted", "stored", "reported", "a month deleted", "a rollup month deleted", "months written", "first months deleted",
         "first months written", "contents deleted", "published"]


@pytest.fixture(scope="module")
def uninterrupted(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("whole")
    home = Home(spark, str(folder / "home"))
    home.load(files(folder, False))
    first = state(home)
    home.load(files(folder, True), reprocess=True)
    return first, state(home)


def test_uninterrupted(uninterrupted):
    (published, firsts, contents, journal), second = uninterrupted
    assert len(published) == 7 and firsts == [("ACME", MARCH), ("Early", APRIL)] and not journal
    assert contents == [("one.csv", "ACME", MARCH, 2), ("one.csv", "Early", APRIL, 1), ("two.csv", "ACME", None, 1), ("two.csv", "ACME", APRIL, 2),
                        ("two.csv", "ACME", MAY, 1)]
    # Replacing a file takes ACME's first month with it.
    assert second[1] == [("ACME", APRIL), ("Early", APRIL), ("Late", MAY)] and not second[3]
    assert len(second[0]) == 9 and all(month != MARCH for _, month, _, _ in second[0])


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_stops_is_made_up_for(spark, tmp_path, monkeypatch, uninterrupted, step):
    home = Home(spark, str(tmp_path / "home"))
    home.load(files(tmp_path, False))
    assert state(home) == uninterrupted[0]
    again = files(tmp_path, True)
    breaks(monkeypatch, spark, home)[step]()
    with pytest.raises(Stop):
        home.load(again, reprocess=True)
    monkeypatch.undo()
    assert home.journal.unfinished()
    home.load(again, reprocess=True)
    assert state(home) == uninterrupted[1]


@pytest.mark.parametrize("step", ["stored", "a month deleted", "first months deleted"])
def test_recovery_alone_publishes_what_is_stored(spark, tmp_path, monkeypatch, uninterrupted, step):
    home = Home(spark, str(tmp_path / "home"))
    home.load(files(tmp_path, False))
    breaks(monkeypatch, spark, home)[step]()
    with pytest.raises(Stop):
        home.load(files(tmp_path, True), reprocess=True)
    monkeypatch.undo()
    assert home.recover() == ["one.csv", "three.csv"]
    assert state(home) == uninterrupted[1] and home.recover() == []


def test_a_file_that_is_only_stored_is_not_skipped_unpublished(spark, tmp_path):
    home = Home(spark, str(tmp_path / "home"))
    path = write(tmp_path / "in.csv", lines(MAY, [1]))
    home.store.load([path])
    assert home.published.lines.count() == 0
    assert rows_of(home.load([path]).select("status")) == [("Skipped",)]
    assert home.published.lines.count() == 1 and rows_of(home.published.firsts) == [("ACME", MAY)]


def test_names_that_paths_escape(spark, tmp_path):
    home = Home(spark, str(tmp_path / "home"))
    path = write(tmp_path / "May 1=15 (50%) ä.csv", lines(MAY, [1, 2]))
    home.load([path])
    write(tmp_path / "May 1=15 (50%) ä.csv", lines(APRIL, [3]))
    home.load([path], reprocess=True)
    assert rows_of(home.published.lines, "source_file", "kimball") == [("May 1=15 (50%) ä.csv", "3")]


def test_a_month_is_built_from_the_files_that_hold_it(spark, tmp_path, capsys):
    home = Home(spark, str(tmp_path / "home"))
    home.load(files(tmp_path, False))
    holding = home.published.contents.where(store_module.F.col("month") == MARCH).select("source_file").distinct()
    home.store.read().join(holding, "source_file", "left_semi").explain("formatted")
    plan = capsys.readouterr().out
    assert "dynamicpruning" in plan.lower()
