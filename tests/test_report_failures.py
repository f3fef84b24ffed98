"""A report that cannot be made stops no other."""

import pytest
from line_rows import MAY, frame, rows_of, spec_rows
from pyspark.sql import functions as F

from cartonwise.catalog import QUERIES
from cartonwise.jobs import Home
from cartonwise.operators.facts import in_months
from cartonwise.plans import supplier_report
from cartonwise.plans.supplier_report import isolated, read_reports, report_parts, write_each_report
from cartonwise.sources.store import publish


def failing(lines, *names):
    bad = in_months(lines, MAY, MAY).groupBy("supplier").agg(F.count("*").alias("lines"))
    return bad.withColumn("lines", F.when(F.col("supplier").isin(*names), F.raise_error(F.concat(F.lit("no "), F.col("supplier")))).otherwise(F.col("lines")))


@pytest.mark.parametrize("names", [(), ("Borea",), ("Aurum", "Echo")])
def test_failing_sections_are_left_out(spark, spec, rules, tmp_path, names):
    path = str(tmp_path / "reports")
    status = {r.supplier: r for r in write_each_report(report_parts(spec, MAY, rules, more={"checked": failing(spec, *names)}), path).collect()}
    assert set(status) == {"Aurum", "Borea", "Cedar", "Delta", "Echo"}
    written = {r.supplier: r["count"] for r in read_reports(spark, path).groupBy("supplier").count().collect()}
    for supplier, row in status.items():
        bad = supplier in names
        assert (row.status, row["items"], row.failed_sections) == ("Incomplete" if bad else "Written", written[supplier], "checked" if bad else None)
        assert (f"no {supplier}" in row.error) if bad else row.error is None
    supplier_report.write_reports(supplier_report.report_items(spec, MAY, rules), str(tmp_path / "plain"))
    got = rows_of(read_reports(spark, path).where("section <> 'checked'"))
    assert got == rows_of(read_reports(spark, str(tmp_path / "plain")))


def test_an_error_of_all_is_raised(spec, rules, tmp_path):
    broken = in_months(spec, MAY, MAY).select("supplier", F.raise_error(F.lit("disk is full")).alias("x"))
    with pytest.raises(Exception, match="disk is full"):
        write_each_report(report_parts(spec, MAY, rules, more={"broken": broken}), str(tmp_path / "reports"), most_failures=2)


def test_few_attempts_find_the_suppliers_at_fault(spark):
    names = spark.range(1000).selectExpr("concat('s', id) as supplier")
    tried = []

    def attempt(part):
        tried.append(1)
        if names.where(part).where("supplier in ('s7', 's900')").count():
            raise ValueError("bad")

    assert sorted(name for name, _ in isolated(names, attempt, 5)) == ["s7", "s900"]
    assert len(tried) <= 80


def test_a_retry_makes_the_rest(spark, tmp_path, monkeypatch, rules):
    home = Home(spark, str(tmp_path / "home"))
    lines = frame(spark, spec_rows(MAY))
    publish(lines, f"{home.published.path}/lines")
    sections = supplier_report.report_sections
    monkeypatch.setattr(supplier_report, "report_sections", lambda rows, *more: sections(rows, *more) | {"checked": failing(lines, "Delta")})
    first = {r.supplier: r.status for r in home.supplier_reports(MAY).collect()}
    assert first == {"Aurum": "Written", "Borea": "Written", "Cedar": "Written", "Delta": "Incomplete", "Echo": "Written"}
    reports = home.folder(MAY, "Supplier_Reports")
    before = rows_of(read_reports(spark, reports).where("supplier <> 'Delta'"))
    monkeypatch.setattr(supplier_report, "report_sections", lambda rows, *more: sections(rows, *more) | {"checked": failing(lines)})
    assert {r.status for r in home.retry_reports(MAY).collect()} == {"Written"}
    assert read_reports(spark, reports).where("supplier = 'Delta' and section = 'checked'").count() == 1
    assert rows_of(read_reports(spark, reports).where("supplier <> 'Delta'")) == before
    assert home.retry_reports(MAY).count() == 5


def test_the_suppliers_at_fault_may_grow_with_all(spark, tmp_path):
    names = spark.range(1100).selectExpr("'BD' as region", "concat('s', id) as supplier")
    sections = {"headline": F.lit("{}"), "checked": F.when(F.expr("supplier like '%07'"), F.raise_error(F.concat(F.lit("no "), "supplier"))).otherwise(F.lit("{}")),
                "late": F.when(F.expr("supplier like 's10_9'"), F.raise_error(F.lit("late"))).otherwise(F.lit("{}"))}
    parts = {name: names.select("region", "supplier", F.lit(name).alias("section"), item.alias("item")) for name, item in sections.items()}
    status = {r.supplier: r for r in write_each_report(parts, str(tmp_path / "reports")).collect()}
    bad = {s: r for s, r in status.items() if r.status != "Written"}
    expected = {f"s{i or ''}07" for i in range(1, 11)} | {f"s10{i}9" for i in range(10)}
    assert len(status) == 1100 and set(bad) == expected
    assert all(r.status == "Incomplete" and r["items"] == 2 for r in bad.values())
    assert all(r.error.endswith(f"no {s}") or f"no {s}" in r.error for s, r in bad.items() if r.failed_sections == "checked")
    assert {r.failed_sections for r in bad.values()} == {"checked", "late"}


def test_folders_are_listed_once(spark, monkeypatch):
    """The driver holds a list of all folders for each table of them that is opened."""
    opened, read = [], supplier_report.read_reports
    monkeypatch.setattr(supplier_report, "read_reports", lambda *a: opened.append(a) or read(*a))
    assert QUERIES["report_fan_out"](spark, "/root/testdata/sf0.001").count() and len(opened) == 1
