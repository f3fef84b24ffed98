"""What a load keeps and reports, and what the monthly jobs read of it."""

import datetime as dt
import re

from line_rows import MAY, rows_of
from test_loading import BASE, write

from cartonwise.functions.dates import shift_month
from cartonwise.jobs import Home
from cartonwise.operators import rates
from cartonwise.operators.facts import in_months
from cartonwise.sources import store
from cartonwise.sources.store import LineStore


def test_untidy_cells(spark, tmp_path):
    rows = [BASE | {"Kimball": str(i), "Current Handover Date": day, "PO Qty": qty, "Description": text} for i, (day, qty, text) in enumerate([
        ("20/01/2024", "12d", "line one\nline two"), ("20-Jan-2024", "1e2", 'a "quoted" word'), ("Jan 20, 2024", "0x1F", "x,y"),
        ("2024/01/20 10:30", "NaN", ""), ("01/20/2024", "7", "z"), ("someday", "8", "z")])]
    path = write(tmp_path / "untidy.csv", rows + [BASE | {"Kimball": "big", "Outer Carton Length (mm)": "1e9"}])
    store = LineStore(spark, str(tmp_path / "store"))
    assert rows_of(store.load([path])) == [("untidy.csv", "Loaded", 7, 4, None, path)]
    got = {r.kimball: r for r in store.read().collect()}
    assert [got[str(i)].handover_date for i in range(6)] == [dt.date(2024, 1, 20)] * 5 + [None]
    assert [got[str(i)].po_qty for i in range(6)] == [None, 100, None, None, 7, 8]
    assert got["0"].description == "line one\nline two" and got["1"].description == 'a "quoted" word' and got["big"].cbm is None


def test_files_of_one_name(spark, tmp_path):
    one, two = write(tmp_path / "a" / "may.csv", [BASE]), write(tmp_path / "b" / "may.csv", [BASE, BASE])
    part = write(tmp_path / "part-numbers May.csv", [BASE])
    store = LineStore(spark, str(tmp_path / "store"))
    got = {(r.path, r.status, r.rows) for r in store.load([one, two, part]).collect()}
    assert got == {(one, "Loaded", 1), (two, "Skipped", None), (part, "Loaded", 1)}
    got = {(r.path, r.status, r.rows) for r in store.load([one, two], reprocess=True).collect()}
    assert got == {(one, "Skipped", None), (two, "Loaded", 2)}
    assert rows_of(store.read().groupBy("source_file").count()) == [("may.csv", 2), ("part-numbers May.csv", 1)]


def test_a_bad_file_is_found_by_halving(spark, tmp_path, monkeypatch):
    paths = [write(tmp_path / f"f{i}.csv", [BASE]) for i in range(9)]
    bad, calls = paths[5], []
    import cartonwise.sources.store as module
    whole = module.read_exports

    def read(spark, layouts, *more):
        calls.append(len(layouts))
        if bad in layouts:
            raise ValueError("unreadable\nin every line")
        return whole(spark, layouts, *more)

    monkeypatch.setattr(module, "read_exports", read)
    got = {r.source_file: (r.status, r.error) for r in LineStore(spark, str(tmp_path / "store")).load(paths).collect()}
    assert got.pop("f5.csv") == ("Failed", "unreadable\nin every line") and set(got.values()) == {("Loaded", None)}
    assert len(calls) <= 9


def test_jobs_read_their_months_only(spark, tmp_path, capsys):
    home = Home(spark, str(tmp_path / "home"))
    april, may = ([BASE | {"Current Handover Date": f"2026-{m:02d}-{d:02d}", "Updated Date": "2026-01-01", "Kimball": str(d)} for d in range(1, 6)]
                  for m in (4, 5))
    home.load([write(tmp_path / "april.csv", april), write(tmp_path / "both.csv", may + april[:1] + [BASE | {"Current Handover Date": ""}])])
    assert rows_of(home.published.lines.groupBy("handover_month").count()) == [(None, 1), (shift_month(MAY, -1), 6), (MAY, 5)]
    assert rows_of(home.published.firsts) == [("ACME", shift_month(MAY, -1))]
    rates.global_rank(in_months(home.published.lines, MAY, MAY)).explain("formatted")
    assert re.search(r"PartitionFilters: .*handover_month#\d+ >= 2026-05-01", capsys.readouterr().out)
    write(tmp_path / "both.csv", may[:2])
    home.load([str(tmp_path / "both.csv")], reprocess=True)
    assert rows_of(home.published.lines.groupBy("handover_month").count()) == [(shift_month(MAY, -1), 5), (MAY, 2)]
    write(tmp_path / "both.csv", april[:1])
    home.load([str(tmp_path / "both.csv")], reprocess=True)
    assert rows_of(home.published.lines.groupBy("handover_month").count()) == [(shift_month(MAY, -1), 6)]
    assert home.latest_month(MAY) == shift_month(MAY, -1)


def test_aliases_and_contacts_are_kept(spark, tmp_path):
    home = Home(spark, str(tmp_path / "home"))
    home.import_aliases(write(tmp_path / "aliases.csv", [{"raw_name": "ACME", "canonical_name": "ACME LTD"}]))
    home.load([write(tmp_path / "a.csv", [BASE])])
    assert rows_of(home.published.lines, "supplier") == [("ACME LTD",)]
    home.set_contact("Acme Ltd", "a@x.com; b@x.com")
    home.export_contacts(str(tmp_path / "sheet"))
    assert rows_of(spark.read.option("header", True).csv(str(tmp_path / "sheet"))) == [("ACME LTD", "a@x.com, b@x.com")]
    home.set_contact("ACME LTD", "")
    assert home.contacts().count() == 0


def test_a_load_moves_no_whole_lines(spark, tmp_path, monkeypatch):
    """Exports hold a file's lines together, so these are stored, and published if files hold few months, by the tasks that read them."""
    written = {}

    def kept(name):
        real = getattr(store, name)

        def run(lines, path, by_file=False, by_month=False):
            together = by_file or by_month
            written.setdefault(name, []).append((together, "Exchange" in lines._jdf.queryExecution().executedPlan().toString()))
            real(lines, path, together)
        monkeypatch.setattr(store, name, run)

    kept("replace_files")
    kept("publish")
    home = Home(spark, str(tmp_path / "home"))
    paths = [write(tmp_path / f"{m}.csv", [BASE | {"Current Handover Date": f"2024-{m:02d}-20", "Kimball": str(k)} for k in range(5)]) for m in (1, 2, 3)]
    assert {r.status for r in home.load(paths).collect()} == {"Loaded"}
    assert written["replace_files"][0] == (True, False) and written["publish"] == [(True, False)]
    many = write(tmp_path / "many.csv", [BASE | {"Current Handover Date": f"20{y}-{m:02d}-20", "Kimball": "9"} for y in (22, 23, 24) for m in range(1, 13)])
    home.load([many])
    assert written["publish"][-1][0] is False
    assert sorted((r.handover_month.month, r["count"]) for r in home.published.lines.where("handover_month >= '2024-01-01'").groupBy("handover_month").count()
                  .collect()) == [(1, 6), (2, 6), (3, 6)] + [(m, 1) for m in range(4, 13)]
    assert home.published.lines.count() == 51 and home.published.rollup.agg({"lines": "sum"}).first()[0] == 51
