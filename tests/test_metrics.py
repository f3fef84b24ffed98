"""The fixture of conftest with hand-computed results, and the rule that dashboards agree with reports."""

import datetime as dt

import pytest
from line_rows import APRIL, MAY, frame, line, rows_of
from pyspark.sql import functions as F

from cartonwise.operators import directory, kpi, rates, summary, supplier
from cartonwise.operators.facts import facts, in_months, rollup
from cartonwise.operators.filters import Filters
from cartonwise.plans import dashboard
from cartonwise.plans.month_summary import NoData, kpi_report, month_summary
from cartonwise.plans.supplier_report import report_items, report_regions

MONTHS = [APRIL, MAY]


@pytest.fixture(scope="module", params=["lines", "rollup"])
def rows(request, spec):
    """Every metric that adds up gives the same on lines and on their rollup."""
    return spec if request.param == "lines" else rollup(spec)


def test_rates_and_ranks(rows):
    got = rows_of(rates.global_rank(rows).select("month", "supplier", F.round("rate", 1), "rank", "total", "shared"))
    april = [("Aurum", 50.0, 3), ("Borea", 75.0, 2), ("Cedar", 100.0, 1), ("Delta", 16.7, 4), ("Echo", 0.0, 5)]
    may = [("Aurum", 87.5, 2), ("Borea", 30.0, 4), ("Cedar", 100.0, 1), ("Delta", 22.2, 5), ("Echo", 50.0, 3)]
    assert got == [(m, *r, 5, False) for m, month in zip(MONTHS, (april, may)) for r in month]
    local = rows_of(rates.local_rank(in_months(rows, MAY, MAY)), "origin_country", "supplier", "rank", "total")
    assert local == [("China", "Borea", 1, 2), ("China", "Delta", 2, 2), ("India", "Aurum", 1, 2), ("India", "Borea", 2, 2),
                     ("Pakistan", "Aurum", 1, 1), ("Portugal", "Cedar", 1, 1), ("Turkey", "Echo", 1, 1)]


def test_shared_ranks(spark):
    data = frame(spark, [line(supplier=s, handover_date=MAY, compliance_status="Compliant" if ok else "Non-compliant")
                         for s, oks in (("A", (1, 0)), ("B", (1, 0, 1, 0)), ("C", (1,)), ("D", (0,))) for ok in oks])
    assert rows_of(rates.global_rank(data).select("supplier", "rank", "total", "shared")) == [
        ("A", 2, 4, True), ("B", 2, 4, True), ("C", 1, 4, False), ("D", 3, 4, False)]


def test_countries(rows):
    assert rows_of(summary.country_compliance(in_months(rows, MAY, MAY)), "country", "rate") == [
        ("China", 23.53), ("India", 71.43), ("Pakistan", 100.0), ("Portugal", 100.0), ("Turkey", 50.0)]
    assert rows_of(summary.country_average(rows, MAY)) == [(68.99, 13.99)]
    assert rows_of(summary.country_average(rows, APRIL)) == [(55.0, None)]


def test_kpi(rows, rules):
    totals = kpi.monthly_totals(kpi.monthly_tables(rows, MAY))
    assert rows_of(totals) == [(APRIL, 6, 6, 28), (MAY, 7, 7, 38)]
    trend = kpi.supplier_factory_trend(rows, MAY, rules)
    columns = ("month", "suppliers", "factories", "bd_suppliers", "bd_factories", "cn_suppliers", "cn_factories")
    assert rows_of(trend, *columns) == [(APRIL, 5, 6, 2, 3, 3, 3), (MAY, 5, 7, 3, 4, 3, 3)]
    regions = kpi.region_lines(rows, MAY, rules)
    assert rows_of(regions, "month", "bd", "cn") == [(APRIL, 9, 19), (MAY, 14, 24)]
    assert rows_of(kpi.lines_per_working_day(rows, MAY, rules)) == [("BD", 14, 21, 1), ("CN", 24, 21, 2)]
    assert rows_of(kpi.lines_per_working_day(rows, APRIL, rules)) == [("BD", 9, 22, 1), ("CN", 19, 22, 1)]
    assert rows_of(kpi.headline(trend, regions, MAY)) == [
        ("factories", 7, 6, 17, 37, 63), ("lines", 38, 28, 36, 37, 63), ("suppliers", 5, 5, 0, 37, 63)]
    assert rows_of(kpi.approver_performance(rows, MAY)) == [("carol", 15, 14, None, 0.9375), ("dave", 16, 14, None, 1.0)]
    assert rows_of(dashboard.approver_change(rows, APRIL)) == [("carol", 14, 0, None), ("dave", 14, 0, None)]
    compared = rows_of(kpi.month_comparison(rows, MAY, rules))
    assert compared == [("China", "CN", 17, 14, None, 45), ("India", "BD", 7, 4, None, 18), ("Pakistan", "BD", 3, 2, None, 8),
                        ("Portugal", "CN", 7, 5, None, 18), ("Turkey", "BD", 4, 3, None, 11)]


def test_headline_without_a_month_before(spec, rules):
    trend, lines = kpi.supplier_factory_trend(spec, APRIL, rules), kpi.region_lines(spec, APRIL, rules)
    assert rows_of(kpi.headline(trend, lines, APRIL), "measure", "now", "before", "change_pct") == [
        ("factories", 6, None, None), ("lines", 28, None, None), ("suppliers", 5, None, None)]


def test_top_and_follow_up(spec, rules):
    top = rows_of(summary.top_suppliers(spec, MAY, rules))
    assert top == [(1, "Cedar", "Portugal", 1, 3, 7, 100.0)]
    low = summary.follow_up(spec, MAY, rules)
    assert rows_of(low, "sl", "supplier", "rate", "prev_1", "prev_2", "avg_3month") == [
        (1, "Delta", 22.2, 16.7, None, 19.4)]


def test_follow_up_needs_month_and_mean_below(spark, rules):
    def month_of_lines(supplier, month, ok, lines):
        return [line(supplier=supplier, handover_date=month, po_qty=1, origin_country="China",
                     compliance_status="Compliant" if i < ok else "Non-compliant") for i in range(lines)]

    march, february = dt.date(2026, 3, 1), dt.date(2026, 2, 1)
    data = [*month_of_lines("recovering", MAY, 3, 10), *month_of_lines("recovering", APRIL, 6, 10),
            *month_of_lines("recovering", march, 6, 10), *month_of_lines("failing", MAY, 3, 10),
            *month_of_lines("failing", APRIL, 2, 10), *month_of_lines("failing", march, 1, 10),
            *month_of_lines("gap", MAY, 3, 10), *month_of_lines("gap", march, 2, 10),
            *month_of_lines("gap", february, 10, 10), *month_of_lines(None, MAY, 0, 10),
            *month_of_lines(None, APRIL, 10, 10)]
    got = rows_of(summary.follow_up(frame(spark, data), MAY, rules), "supplier", "prev_1", "prev_2", "avg_3month")
    assert got == [(None, None, None, 0.0), ("failing", 20.0, 10.0, 20.0), ("gap", None, 20.0, 25.0)]
    shown = dashboard.dashboard_suppliers(frame(spark, data), Filters(MAY), rules)
    assert rows_of(shown, "supplier", "avg_3m", "change") == [
        (None, 50.0, -100.0), ("failing", 20.0, 10.0), ("gap", 25.0, None), ("recovering", 50.0, -30.0)]


def test_dashboard_equals_reports(rows, spec, rules):
    shown = dashboard.dashboard_suppliers(rows, Filters(MAY), rules)
    assert rows_of(shown, "supplier", "region", "compliance", "band", "change", "rank") == [
        ("Aurum", "BD", 87.5, "high", 37.5, 2), ("Borea", "CN", 30.0, "low", -45.0, 4), ("Cedar", "CN", 100.0, "high", 0.0, 1),
        ("Delta", "CN", 22.2, "low", 5.6, 5), ("Echo", "BD", 50.0, "mid", 50.0, 3)]
    assert rows_of(shown, "supplier", "rank") == rows_of(
        rates.global_rank(in_months(rows, MAY, MAY)), "supplier", "rank")
    cards = dashboard.dashboard_cards(rows, Filters(MAY), rules).first().asDict()
    assert cards == {"compliance": 55.3, "compliance_change": 1.7, "top_count": 1, "top_change": 0,
                     "follow_up_count": 1, "pending": 0, "approved": 31, "rejected": 0, "escalated": 7, "total": 38,
                     "all": 5, "high": 2, "mid": 1, "low": 2}
    assert cards["follow_up_count"] == summary.follow_up(spec, MAY, rules).count()
    first = dashboard.dashboard_cards(rows, Filters(APRIL), rules).first()
    assert (first.compliance_change, first.top_change) == (None, None)


def test_dashboard_filters(rows, rules):
    def names(**asked):
        return [r[0] for r in rows_of(dashboard.dashboard_suppliers(rows, Filters(MAY, **asked), rules), "supplier")]

    assert names(region="bd") == ["Aurum", "Echo"]
    assert names(region="all", country="") == ["Aurum", "Borea", "Cedar", "Delta", "Echo"]
    assert names(country="India") == ["Aurum", "Borea"]
    # Filtered to one country Borea still is a CN supplier: its region comes from all its lines.
    assert names(country="India", region="CN") == ["Borea"]
    assert names(supplier="cE") == ["Cedar"] and names(supplier="c%") == [] and names(factory="a1") == ["Aurum"]
    filtered = dashboard.dashboard_suppliers(rows, Filters(MAY, factory="B2"), rules)
    assert rows_of(filtered, "supplier", "countries", "lines", "rank") == [("Borea", "India", 2, 4)]
    empty = dashboard.dashboard_cards(rows, Filters(MAY, supplier="nobody"), rules).first()
    assert (empty.compliance, empty.top_count, empty.top_change, empty.total) == (None, 0, None, 0)


def test_dashboard_charts(rows, rules):
    assert rows_of(dashboard.rate_trend(rows, Filters(MAY), rules)) == [(APRIL, 33.3, 63.2, 53.6), (MAY, 71.4, 45.8, 55.3)]
    assert rows_of(dashboard.rate_trend(rows, Filters(MAY, country="India"), rules)) == [
        (APRIL, 25.0, None, 25.0), (MAY, 71.4, None, 71.4)]
    assert dashboard.rate_trend(rows, Filters(dt.date(2020, 1, 1)), rules).count() == 0
    assert rows_of(dashboard.country_bars(rows, Filters(MAY), rules)) == [
        (1, "Pakistan", 100.0), (2, "Portugal", 100.0), (3, "India", 71.4), (4, "Turkey", 50.0), (5, "China", 23.5)]


def test_kpi_dashboard_equals_kpi_report(rows, rules):
    shown = dashboard.kpi_dashboard(rows, Filters(MAY), rules)
    cards = shown.cards.first().asDict()
    assert cards == {"lines": 38, "lines_change_pct": 36, "suppliers": 5, "suppliers_change": 0, "factories": 7,
                     "factories_change": 1, "bd_lines": 14, "bd_working_days": 21, "bd_avg": 1, "cn_lines": 24,
                     "cn_working_days": 21, "cn_avg": 2}
    assert rows_of(shown.people, "month", "bd_lines", "cn_lines") == rows_of(
        kpi.region_lines(rows, MAY, rules), "month", "bd", "cn")
    assert rows_of(shown.countries, "country", "lines_m0", "share") == rows_of(
        kpi.month_comparison(rows, MAY, rules), "country", "lines_m0", "share")
    assert rows_of(shown.approvers) == [("carol", 15, 14, 7), ("dave", 16, 14, 14)]
    one = dashboard.kpi_dashboard(rows, Filters(MAY, region="BD", approved_by="dave"), rules)
    assert one.cards.first().lines == one.people.where(F.col("month") == MAY).first().bd_lines > 0
    before = dashboard.kpi_dashboard(rows, Filters(dt.date(2020, 1, 1)), rules).cards.first()
    assert (before.lines, before.lines_change_pct, before.suppliers_change) == (0, None, None)


def test_series_and_grids(spark, rules):
    def on(month, **values):
        return line(supplier="A", handover_date=month, **values)

    data = [on(dt.date(2026, 2, 3), compliance_status="Compliant", packaging_status="Approved", density=10),
            on(dt.date(2026, 4, 3), compliance_status="Non-compliant", packaging_status="Approved", density=None),
            on(dt.date(2026, 4, 4), compliance_status="Compliant", packaging_status="Pending", density=99),
            line(supplier="B", handover_date=dt.date(2026, 6, 1), compliance_status="Compliant"),
            line(supplier="OLD", handover_date=dt.date(2020, 1, 1), compliance_status="Compliant")]
    from decimal import Decimal
    data = [tuple(Decimal(v) if f == "density" and v is not None else v
                  for f, v in zip(frame(spark, []).columns, r)) for r in data]
    lines = frame(spark, data)
    got = rows_of(supplier.supplier_series(lines, MAY, rules).where("supplier = 'A'"), "month", "compliance",
                  "approved", "density")
    assert got == [(dt.date(2026, 2, 1), 100.0, 100.0, 10.0), (dt.date(2026, 3, 1), 0.0, 0.0, 0.0),
                   (APRIL, 50.0, 50.0, 0.0), (MAY, 0.0, 0.0, 0.0)]
    counts = rows_of(supplier.supplier_series(lines, MAY, rules).groupBy("supplier").count())
    assert counts == [("A", 4), ("OLD", 12)]  # B starts after the report month
    grid = summary.supplier_trend(lines, MAY, rules)
    assert rows_of(grid.where("supplier = 'A' and rate is not null"), "month", "rate") == [
        (dt.date(2026, 2, 1), 100.0), (APRIL, 50.0)]
    assert grid.count() == 12
    assert rows_of(summary.yearly_average(grid, rules)) == [("A", 75.0, "none")]
    assert supplier.supplier_series(lines, dt.date(2019, 1, 1), rules).count() == 0


def test_gaps_in_calendar_windows(spark):
    def lines(month, ok):
        return [line(supplier="A", handover_date=month, compliance_status="Compliant" if ok else "Non-compliant")]

    months = [dt.date(2025, 11, 1), dt.date(2025, 12, 1), dt.date(2026, 1, 1), dt.date(2026, 4, 1)]
    data = frame(spark, [r for m, ok in zip(months, (1, 0, 0, 1)) for r in lines(m, ok)])
    rated = rates.rates(facts(data), "supplier", "month")
    assert rows_of(rates.add_change(rated, "supplier"), "month", "prev_rate", "change") == [
        (months[0], None, None), (months[1], 100.0, -100.0), (months[2], 0.0, 0.0), (months[3], None, None)]
    rolled = rates.add_rolling_mean(rated, "supplier").select("month", F.round("avg_3m", 2))
    assert rows_of(rolled) == [(months[0], 100.0), (months[1], 50.0), (months[2], 33.33), (months[3], 100.0)]


def test_null_groups(spark, rules):
    data = frame(spark, [line(supplier=None, origin_country=None, factory=None, handover_date=MAY,
                              packaging_status=None, compliance_status="Compliant"),
                         line(supplier="A", origin_country=None, handover_date=MAY, packaging_status="Approved",
                              compliance_status="Non-compliant")])
    assert rows_of(rates.global_rank(data), "supplier", "rank", "total") == [(None, 1, 1), ("A", 2, 1)]
    assert rows_of(rates.local_rank(data), "supplier", "rank", "total", "shared") == [
        (None, 0, 0, False), ("A", 0, 0, False)]
    assert rows_of(kpi.lines_per_working_day(data, MAY, rules), "region", "lines") == [("BD", 0), ("CN", 0)]
    cards = dashboard.kpi_dashboard(data.withColumn("approved_by", F.lit(None).cast("string")), Filters(MAY), rules)
    assert cards.cards.first().cn_lines == 1  # the dashboard counts lines without a country as CN
    assert rows_of(supplier.supplier_kpis(data), "supplier", "origin_countries", "factory_count") == [
        (None, None, 0), ("A", None, 0)]
    assert rows_of(report_regions(data, rules)) == [(None, "CN"), ("A", "CN")]
    assert rows_of(kpi.region_lines(data, MAY, rules), "bd", "cn") == [(0, 2)]


def test_directory(spark, spec, rules):
    contacts = spark.createDataFrame([("cedar", "b@x.com"), ("cedar", "a@x.com"), ("bygone ltd", "g@x.com")],
                                     "supplier_name string, email string")
    countries = directory.supplier_countries(spec)
    listed = directory.supplier_directory(countries, contacts, rules)
    assert rows_of(listed) == [(1, "Aurum", "", "BD"), (2, "Borea", "", "CN"), (3, "bygone ltd", "g@x.com", None),
                               (4, "Cedar", "a@x.com, b@x.com", "CN"), (5, "Delta", "", "CN"), (6, "Echo", "", "BD")]
    found = directory.directory_rows(countries, listed, rules, "E", "2026-04", "CN")
    assert rows_of(found, "name") == [("Borea",), ("Cedar",), ("Delta",)]
    assert rows_of(directory.directory_rows(countries, listed, rules, "LTD"), "name") == [("bygone ltd",)]
    assert rows_of(directory.directory_months(countries)) == [(1, "2026-05"), (2, "2026-04")]
    low = summary.add_emails(spark.createDataFrame([("Cedar",), ("Delta",)], "supplier string"), contacts)
    assert rows_of(low) == [("Cedar", "a@x.com, b@x.com"), ("Delta", "")]


def test_search(spec):
    assert rows_of(directory.search_names(spec, MAY, " eD ")) == [("supplier", "Cedar", "Cedar")]
    assert rows_of(directory.search_names(spec, MAY, "b2")) == [("factory", "B2", "Borea")]
    assert directory.search_names(spec, MAY, "  ").count() == 0
    assert directory.search_names(spec, MAY, "%").count() == 0
    assert rows_of(directory.filter_options(spec, MAY), "kind", "position", "value") == [
        ("approver", 1, "carol"), ("approver", 2, "dave"), ("country", 1, "China"), ("country", 2, "India"),
        ("country", 3, "Pakistan"), ("country", 4, "Portugal"), ("country", 5, "Turkey")]


def test_bundles(spark, spec, rules):
    contacts = spark.createDataFrame([], "supplier_name string, email string")
    summary_tables = month_summary(spec, contacts, MAY, rules)
    assert rows_of(summary_tables["sources"]) == [(5, 7)]
    assert rows_of(summary_tables["line_totals"], "reflected_lines", "dest_po_count") == [(38, 15)]
    assert rows_of(summary_tables["country_order"], "position", "country") == [
        (1, "China"), (2, "India"), (3, "Pakistan"), (4, "Portugal"), (5, "Turkey")]
    assert rows_of(summary_tables["working_days"], "cn_days", "calendar_days") == [(21, 31)]
    assert all(df.count() > 0 for df in summary_tables.values())
    assert all(df.count() > 0 for df in kpi_report(spec, MAY, rules).values())
    with pytest.raises(NoData):
        kpi_report(spec, dt.date(2020, 1, 1), rules)


def test_supplier_reports(spark, spec, rules):
    import json

    chosen = spark.createDataFrame([("Borea",), ("Borea",), ("nobody",)], "supplier string")
    items = report_items(spec, MAY, rules, chosen, with_transactions=True)
    got = [(r.region, r.supplier, r.section, json.loads(r.item)) for r in items.collect()]
    assert {g[:2] for g in got} == {("CN", "Borea")}
    by_section = {}
    for g in got:
        by_section.setdefault(g[2], []).append(g[3])
    assert by_section["headline"] == [{"month": "2026-05-01", "lines": 10, "compliant": 3, "rate": 30.0, "band": "low"}]
    assert [(r["rank"], r["total"], r["shared"]) for r in by_section["ranking"]] == [(4, 5, False)]
    assert {k: len(v) for k, v in by_section.items()} == {
        "headline": 1, "kpis": 1, "ranking": 1, "local_ranking": 2, "factories": 2, "factory_bands": 2,
        "line_details": 2, "line_totals": 1, "carton_usage": 2, "series": 2, "transactions": 10}
