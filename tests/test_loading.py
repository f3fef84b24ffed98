import csv
import datetime as dt
import re

import pytest
from line_rows import MAY, rows_of
from pyspark.sql import functions as F

from cartonwise.functions.text import WHITE_SPACE, clean_text
from cartonwise.operators import rates
from cartonwise.operators.facts import in_months
from cartonwise.schema import HEADERS, LINES
from cartonwise.sources import exports, store
from cartonwise.sources.store import (LineStore, clear, pending_files, publish, publish_rollup, read_published,
                                      replace_files)
from cartonwise.streaming.ingest import start_ingest

BASE = {"Supplier": "ACME", "Carton Matrix Code": "MATRIX123", "Packaging Confirmation Status": "Approved",
        "Current Handover Date": "2024-01-20", "Updated Date": "2024-01-15", "Units Per Carton": "12",
        "Outer Carton Length (mm)": "1000", "Outer Carton Width (mm)": "1000", "Outer Carton Height (mm)": "1000"}


def write(path, rows, headers=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    headers = headers or list(rows[0])
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(headers)
        out.writerows([r.get(h, "") for h in headers] for r in rows)
    return str(path)


def load(spark, tmp_path, *rows, aliases=None):
    """One export with the rows, as loaded lines in order of their kimball."""
    rows = [BASE | {"Kimball": f"{i:03d}"} | r for i, r in enumerate(rows)]
    path = write(tmp_path / "one file (1)+a%.csv", rows)
    raw = exports.read_exports(spark, {path: exports.layout_of(spark, path)})
    return exports.conform(raw, aliases).orderBy("kimball").collect()


def test_derived_columns(spark, tmp_path):
    got = load(spark, tmp_path, {}, {"Carton Matrix Code": ""}, {"Carton Matrix Code": "None"},
               {"Outer Carton Width (mm)": ""}, {"Units Per Carton": "x"}, {"Outer Carton Length (mm)": "0"})
    assert [r.carton_type for r in got[:3]] == ["Standard", "Custom", "Custom"]
    assert [r.cbm and float(r.cbm) for r in got] == [1.0, 1.0, 1.0, None, 1.0, 0.0]
    assert [r.density and float(r.density) for r in got] == [12.0, 12.0, 12.0, None, None, None]
    assert {r.source_file for r in got} == {"one file (1)+a%.csv"}


@pytest.mark.parametrize("change, verdict", [
    ({}, "Compliant"), ({"Updated Date": "2024-01-20"}, "Compliant"), ({"Updated Date": "2024-01-21"}, "Non-compliant"),
    ({"Packaging Confirmation Status": "Rejected"}, "Non-compliant"), ({"Updated Date": ""}, "Non-compliant"),
    ({"Current Handover Date": "soon"}, "Non-compliant"), ({"Packaging Confirmation Status": ""}, "Non-compliant"),
    # 23:30 in a western zone is the next day in UTC, but the date as written counts.
    ({"Updated Date": "2024-01-20T23:30:00-07:00"}, "Compliant"),
])
def test_verdict(spark, tmp_path, change, verdict):
    assert load(spark, tmp_path, change)[0].compliance_status == verdict


def test_cells_are_coerced_or_null(spark, tmp_path):
    got = load(spark, tmp_path, {"PO Qty": "12.5", "Factory": "  F 1 "}, {"PO Qty": "1e2", "Factory": "nan"},
               {"PO Qty": "many", "Current Handover Date": "2024-13-01"}, {"PO Qty": "13.5"},
               {"Updated Date": "2024-01-15T23:30:00-07:00"})
    assert [r.po_qty for r in got[:4]] == [12, 100, None, 14]
    assert [r.factory for r in got[:2]] == ["F 1", None]
    assert got[2].handover_date is None
    assert got[4].updated_date.astimezone(dt.timezone.utc).replace(tzinfo=None) == dt.datetime(2024, 1, 16, 6, 30)


def test_aliases_match_exactly_after_trimming(spark, tmp_path):
    aliases = spark.createDataFrame([("ACME", "ACME LTD (1)")], "raw_name string, canonical_name string")
    got = load(spark, tmp_path, {"Supplier": " ACME "}, {"Supplier": "acme"}, {"Supplier": ""}, aliases=aliases)
    assert [r.supplier for r in got] == ["ACME LTD (1)", "acme", None]


def test_layouts_may_differ_between_files(spark, tmp_path):
    few = write(tmp_path / "few.csv", [{"Carton Matrix Code": "M", "Supplier": "A", "Unknown": "z", "Colour": "red"}])
    all_of_it = write(tmp_path / "all.csv", [dict.fromkeys(HEADERS, "1") | BASE], list(reversed(HEADERS)))
    store = LineStore(spark, str(tmp_path / "store"))
    assert rows_of(store.load([few, all_of_it]).select("source_file", "status", "rows")) == [("all.csv", "Loaded", 1), ("few.csv", "Loaded", 1)]
    assert store.read().schema == LINES
    parquet = str(tmp_path / "columns.parquet")
    spark.createDataFrame([("M", "P", 7)], "`Carton Matrix Code` string, Supplier string, `PO Qty` int").write.parquet(
        parquet)
    assert rows_of(store.load([few, parquet]).select("source_file", "status", "rows")) == [
        ("columns.parquet", "Loaded", 1), ("few.csv", "Skipped", None)]
    assert rows_of(store.rows_of(["columns.parquet"]), "supplier", "po_qty") == [("P", 7)]
    store = LineStore(spark, str(tmp_path / "second"))
    store.load([few, all_of_it])
    assert rows_of(store.read(), "supplier", "area", "carton_type") == [
        ("A", None, "Standard"), ("ACME", "1", "Standard")]


def test_load_report_skips_replaces_and_isolates(spark, tmp_path):
    store = LineStore(spark, str(tmp_path / "store"))
    a = write(tmp_path / "a.csv", [BASE, BASE])
    b = write(tmp_path / "b (2).csv", [BASE])
    bad = write(tmp_path / "bad.csv", [{"Supplier": "A", "Contact": "b"}])
    empty = write(tmp_path / "empty.csv", [], list(BASE))
    gone = str(tmp_path / "gone.csv")
    assert rows_of(store.load([a]).select("source_file", "status", "rows")) == [("a.csv", "Loaded", 2)]
    report = {r.source_file: (r.status, r.rows) for r in store.load([a, b, bad, empty, gone]).collect()}
    assert report == {"a.csv": ("Skipped", None), "b (2).csv": ("Loaded", 1), "bad.csv": ("Failed", None),
                      "empty.csv": ("Failed", None), "gone.csv": ("Failed", None)}
    write(tmp_path / "a.csv", [BASE, BASE, BASE])
    again = {r.source_file: (r.status, r.rows) for r in store.load([a, b], reprocess=True).collect()}
    assert again == {"a.csv": ("Loaded", 3), "b (2).csv": ("Loaded", 1)}
    assert rows_of(store.read().groupBy("source_file").count()) == [("a.csv", 3), ("b (2).csv", 1)]
    # A file that comes back empty fails and leaves its earlier rows alone.
    write(tmp_path / "a.csv", [], list(BASE))
    assert rows_of(store.load([a], reprocess=True)) == [("a.csv", "Failed", None, None, "no rows", a)]
    assert store.read().where("source_file = 'a.csv'").count() == 3


def test_pending_and_clear(spark, tmp_path, spec):
    path = str(tmp_path / "store")
    store = LineStore(spark, path)
    assert store.read().count() == 0
    replace_files(spec, path)
    offered = spark.createDataFrame([("spec.csv",), ("new.csv",)], "source_file string")
    assert rows_of(pending_files(offered, store.read())) == [("new.csv",)]
    clear(spark, path)
    assert store.read().count() == 0


def test_published_tables_serve_the_same_metrics(spark, tmp_path, spec, capsys):
    lines_path, rollup_path = str(tmp_path / "serving"), str(tmp_path / "rollup")
    publish(spec, lines_path)
    publish_rollup(spec, rollup_path)
    served = in_months(read_published(spark, lines_path), MAY, MAY)
    served.explain("formatted")
    assert re.search(r"PartitionFilters: .*handover_month#\d+ >= 2026-05-01", capsys.readouterr().out)
    assert rows_of(rates.global_rank(served)) == rows_of(rates.global_rank(in_months(spec, MAY, MAY)))
    totals = spark.read.parquet(rollup_path).groupBy("month").sum("lines", "compliant")
    assert rows_of(totals, "sum(lines)", "sum(compliant)") == [(28, 15), (38, 21)]


def test_stream_loads_each_arrival_once(spark, tmp_path):
    store = LineStore(spark, str(tmp_path / "store"))
    folder, checkpoint = tmp_path / "in", str(tmp_path / "checkpoint")

    def run():
        start_ingest(store, str(folder), checkpoint, pattern="*.csv").awaitTermination()
        return rows_of(store.read().groupBy("source_file").count())

    write(folder / "a.csv", [BASE, BASE])
    assert run() == [("a.csv", 2)]
    assert run() == [("a.csv", 2)]
    write(folder / "b.csv", [BASE])
    write(folder / "bad.csv", [{"Nothing": "here"}])
    assert run() == [("a.csv", 2), ("b.csv", 1)]


def test_exports_are_loaded_in_small_parts(spark, tmp_path, monkeypatch):
    """Packed files can't be cut, so tasks of many of them would end far apart."""
    seen, key = [], "spark.sql.files.maxPartitionBytes"
    read, before = store.read_exports, spark.conf.get(key)
    monkeypatch.setattr(store, "read_exports", lambda *a: seen.append(spark.conf.get(key)) or read(*a))
    LineStore(spark, str(tmp_path / "lines")).load([write(tmp_path / "may.csv", [BASE])])
    assert seen == [str(16 << 20)] and spark.conf.get(key) == before


def test_no_method_is_too_large_to_be_compiled(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_cells_are_cleaned_as_by_a_search_of_each(spark):
    ends = ["", " ", "\t", "\u3000", "\x85", "\x7f", "\x1f", "é", "!", "~"]
    cells = [a + b + c for a in ends for b in ("", "x", "nan", "a b", "ü") for c in ends]
    rows = spark.createDataFrame([(c,) for c in cells] + [(None,)], "cell string")
    plain = F.nullif(F.trim("cell", F.lit(WHITE_SPACE)), F.lit("nan"))
    assert rows.where(~clean_text(F.col("cell")).eqNullSafe(plain)).count() == 0


def test_names_of_exports(spark):
    paths = {"file:/a/b c.csv": (False, "b c.csv"), "file:/a/m%20%2B%25+x.csv": (False, "m +%+x.csv"), "file:/a/source_file=1%202/part.csv": (True, "1 2"),
             "s3a://a/source_file=x%252Fy/part-0.csv.gz": (True, "x%2Fy"), "file:/a/source_file=b.csv": (False, "b.csv")}
    for path, (folder, name) in paths.items():
        assert spark.createDataFrame([(path,)], "p string").select(exports._source_file(folder, "p")).first()[0] == name
