import datetime as dt

import pytest
from line_rows import APRIL, MAY, frame, line, rows_of

from cartonwise.config import NoData
from cartonwise.functions.dates import shift_month
from cartonwise.operators import directory
from cartonwise.operators.transactions import transactions, transactions_page
from cartonwise.plans.supplier_report import read_reports, report_items, write_reports
from cartonwise.schema import HEADERS
from cartonwise.sources import contacts, extracts


def cells(spark, rows, *headers):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers))


def test_import_contacts(spark):
    sheet = cells(spark, [("a@x.com; b@x.com,", "ACME"), (None, "NO EMAIL LTD"), ("c@x.com", " acme "),
                          ("z@x.com", None), ("a@x.com", "Acme")], "E-MAIL (email)", " supplier  Name ")
    assert rows_of(contacts.import_contacts(sheet)) == [
        ("acme", "a@x.com"), ("acme", "b@x.com"), ("acme", "c@x.com")]
    for headers in (("Supplier", "Contact"), ("Supplier Name", "Phone"), ("Email", "Phone")):
        with pytest.raises(contacts.BadContacts):
            contacts.import_contacts(cells(spark, [("a", "b")], *headers))


def test_replace_contacts(spark):
    stored = spark.createDataFrame([("acme", "old@x.com"), ("gone ltd", "g@x.com"), ("kept", "k@x.com")],
                                   "supplier_name string, email string")
    typed = spark.createDataFrame([(" ACME ", "a@x.com; b@x.com,a@x.com"), ("gone ltd", " , "), ("none", None)],
                                  "supplier_name string, emails string")
    assert rows_of(contacts.replace_contacts(stored, contacts.typed_contacts(typed))) == [
        ("acme", "a@x.com"), ("acme", "b@x.com"), ("kept", "k@x.com")]


def test_sheet_can_be_imported_again(spark, spec, rules):
    stored = spark.createDataFrame([("cedar", "b@x.com"), ("cedar", "a@x.com"), ("gone", "g@x.com")],
                                   "supplier_name string, email string")
    listed = directory.supplier_directory(directory.supplier_countries(spec), stored, rules)
    sheet = contacts.contacts_sheet(listed)
    assert [r[0] for r in sheet.collect()] == ["Aurum", "Borea", "Cedar", "Delta", "Echo", "gone"]
    assert rows_of(contacts.import_contacts(sheet)) == rows_of(stored)


def _utc(*args):
    return dt.datetime(*args, tzinfo=dt.timezone.utc)


def test_month_extract(spark, spec):
    west = dt.timezone(dt.timedelta(hours=-7))
    data = frame(spark, [
        line(supplier="B", handover_date=dt.date(2026, 5, 2), updated_date=_utc(2026, 5, 1, 8), source_file="f"),
        line(supplier="A", handover_date=dt.date(2026, 5, 2), updated_date=dt.datetime(2026, 4, 30, 23, 30, tzinfo=west)),
        line(supplier="C", handover_date=dt.date(2026, 5, 1)), line(supplier="D", handover_date=dt.date(2026, 6, 1))])
    got = extracts.month_extract(data, MAY)
    assert set(got.columns) == {*HEADERS, "Compliance Status"}
    # Sheets have no time zone: the western evening is a UTC morning, before 08:00.
    assert [(r["Supplier"], r["Updated Date"]) for r in got.collect()] == [
        ("C", None), ("A", dt.datetime(2026, 5, 1, 6, 30)), ("B", dt.datetime(2026, 5, 1, 8))]
    assert [r["Supplier"] for r in extracts.month_extract(data, MAY, "B").collect()] == ["B"]


def test_written_extracts(spark, spec, rules, tmp_path):
    aliases = spark.createDataFrame([("Borea", "Bor/ea")], "raw_name string, canonical_name string")
    month, by_supplier = str(tmp_path / "month"), str(tmp_path / "suppliers")
    extracts.write_month_extract(spec, MAY, month)
    assert spark.read.option("header", True).csv(month).count() == 38
    extracts.write_by_supplier(extracts.by_supplier(spec, MAY, rules, aliases), by_supplier)
    written = spark.read.option("header", True).csv(by_supplier)
    assert rows_of(written.groupBy("region", "supplier_file").count()) == [
        ("BD", "Aurum", 8), ("BD", "Echo", 4), ("CN", "Bor_ea", 10), ("CN", "Cedar", 7), ("CN", "Delta", 9)]
    with pytest.raises(NoData):
        extracts.write_month_extract(spec, shift_month(MAY, 1), month)
    nobody = spark.createDataFrame([("nobody",)], "supplier string")
    with pytest.raises(NoData):
        extracts.write_by_supplier(extracts.selected(spec, MAY, nobody, rules), by_supplier)
    some = spark.createDataFrame([("Cedar",), ("Delta",), ("Cedar",), ("nobody",)], "supplier string")
    chosen = extracts.selected(spec, MAY, some, rules)
    assert rows_of(chosen.groupBy("supplier").count()) == [("Cedar", 7), ("Delta", 9)]


@pytest.mark.parametrize("kind", ["extract", "reports"])
def test_folders_of_many_suppliers(spark, rules, tmp_path, kind):
    """Each supplier costs a folder and a file, without a checksum file; and the folders are listed by a few tasks, not one each."""
    lines = frame(spark, [line(supplier=f"S{i:03}", origin_country="Turkey", handover_date=dt.date(2026, 5, 1 + i % 28)) for i in range(200)])
    path = str(tmp_path / kind)
    spark.sparkContext.setJobGroup("many", "many")
    try:
        if kind == "extract":
            extracts.write_by_supplier(extracts.by_supplier(lines, MAY, rules), path)
        else:
            write_reports(report_items(lines, MAY, rules), path)
        spark.sparkContext.setJobGroup("read", "read")
        found = extracts.read_by_supplier(spark, path) if kind == "extract" else read_reports(spark, path)
        tracker = spark.sparkContext.statusTracker()
        listed = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("read") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setJobGroup("", "")
    assert listed and max(listed) <= 4 * spark.sparkContext.defaultParallelism
    assert found.select("supplier_file").distinct().count() == 200
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
    assert not list((tmp_path / kind).rglob("*.crc"))


def test_names_in_folders_stay_text(spark, rules, tmp_path):
    lines = frame(spark, [line(supplier=s, origin_country="Turkey", handover_date=dt.date(2026, 5, 4)) for s in ("007", "2026-05")])
    extracts.write_by_supplier(extracts.by_supplier(lines, MAY, rules), str(tmp_path / "x"))
    read = extracts.read_by_supplier(spark, str(tmp_path / "x"))
    assert set(read.columns) == {*HEADERS, "Compliance Status", "region", "supplier_file"}
    assert rows_of(read, "region", "supplier_file", "Supplier") == [("BD", "007", "007"), ("BD", "2026-05", "2026-05")]


def test_written_reports(spark, spec, rules, tmp_path):
    done = write_reports(report_items(spec, MAY, rules), str(tmp_path / "reports"))
    assert [r[:2] for r in rows_of(done)] == [("BD", "Aurum"), ("BD", "Echo"), ("CN", "Borea"), ("CN", "Cedar"),
                                              ("CN", "Delta")]


def test_transactions(spark, spec):
    rows, page, total = transactions_page(spec, "Borea", MAY, None, 99, 4)
    assert (page, total) == (3, 10)
    assert [r.handover_date.day for r in rows.collect()] == [20, 23]
    assert transactions_page(spec, "Borea", MAY, "b1_", 1)[2] == 0  # the underscore is literal
    assert transactions_page(spec, "Borea", MAY, " b1-1 ", 1)[2] == 3
    shown = transactions(frame(spark, [line(handover_date=APRIL, carton_length_mm=400, carton_height_mm=20)]), APRIL)
    assert rows_of(shown, "handover_text", "updated_text", "carton_size") == [("01 Apr 2026", None, "400×0×20")]
