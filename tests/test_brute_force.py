"""Random lines with gaps, nulls and blanks: the composite queries against plain Python over the same rows."""

import datetime as dt
import math
import random

import pytest
from line_rows import MAY, frame, line, rows_of

from cartonwise.config import BD_COUNTRIES
from cartonwise.functions.dates import shift_month
from cartonwise.operators import kpi, summary, supplier
from cartonwise.operators.filters import Filters
from cartonwise.plans import dashboard

COUNTRIES = ["India", "Turkey", "China", "Vietnam", "", None]
STATUS = ["Approved", "Pending", "Approval Rejected", "Escalated", "Other", None]


def months_before(n):
    return shift_month(MAY, -n)


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(request, spark):
    source = random.Random(request.param)
    rows = []
    for _ in range(1500):
        month = months_before(source.choice([-1, 0, 0, 0, 1, 1, 2, 3, 5, 11, 12, 12, 13, 15]))
        supplier_name = source.choice(["A", "B", "b%", "C_1", "D", "E", None])
        if supplier_name == "D" and month < months_before(3):
            continue
        if supplier_name == "E" and month == months_before(1):
            continue
        # E ships from one region only, A and None are often without a country.
        country = source.choice(["India", "Turkey"] if supplier_name == "E" else
                                ["", None] if supplier_name == "B" else COUNTRIES)
        bias = {"A": .97, "B": .1, "E": .3}.get(supplier_name, .6)
        rows.append(dict(
            supplier=supplier_name, origin_country=country, factory=source.choice(["F1", "F2", "f10", "", None]),
            destination_po=source.choice(["P1", "P2", "P3", "P4", None]), po_qty=source.choice([1, 5, None]),
            approved_by=source.choice(["ann", "bob", "", None]), packaging_status=source.choice(STATUS),
            compliance_status="Compliant" if source.random() < bias else "Non-compliant",
            handover_date=None if source.random() < .01 else month.replace(day=source.randrange(1, 28))))
    return frame(spark, [line(**r) for r in rows]).repartition(5).persist(), rows


def month_of(row):
    return row["handover_date"] and row["handover_date"].replace(day=1)


def of(rows, month):
    return [r for r in rows if month_of(r) == month]


def rate(rows):
    return sum(r["compliance_status"] == "Compliant" for r in rows) / len(rows) * 100 if rows else None


def one_digit(value):
    return None if value is None else round(value, 1)


def by(rows, key):
    groups = {}
    for r in rows:
        groups.setdefault(r[key], []).append(r)
    return groups


def distinct(rows, key):
    return len({r[key] for r in rows if r[key] is not None})


def band(value):
    return "high" if value >= 70 else "mid" if value >= 40 else "low"


def region(country):
    return "BD" if country in BD_COUNTRIES else "CN"


def passes(row, asked):
    def has(column):
        text = asked.get(column)
        return text is None or (row[column] is not None and text.lower() in row[column].lower())

    return (has("supplier") and has("factory") and asked.get("country") in (None, row["origin_country"])
            and asked.get("approved_by") in (None, row["approved_by"]))


REQUESTS = [{}, {"region": "BD"}, {"region": "CN"}, {"factory": "f1"}, {"supplier": "_"}, {"supplier": "%"},
            {"country": "India", "region": "BD"}, {"approved_by": "ann", "region": "CN"}, {"supplier": "nobody"}]


def expected_dashboard(rows, asked):
    kept = [r for r in rows if passes(r, asked)]
    cur, prev, prev2 = (by(of(kept, months_before(i)), "supplier") for i in range(3))
    everyone = by(of(rows, MAY), "supplier")
    regions = {s: "BD" if all(region(r["origin_country"]) == "BD" for r in g if r["origin_country"]) else "CN"
               for s, g in everyone.items()}
    levels = sorted({rate(g) for g in everyone.values()}, reverse=True)
    if asked.get("region"):
        cur = {s: g for s, g in cur.items() if regions[s] == asked["region"]}
        prev, prev2 = ({s: g for s, g in old.items() if s in cur} for old in (prev, prev2))
    table, low = [], 0
    for s, g in cur.items():
        rates = [rate(old[s]) for old in (cur, prev, prev2) if s in old]
        mean = sum(rates) / len(rates)
        low += rates[0] < 40 and mean < 40
        table.append((s, regions[s], ", ".join(sorted({r["origin_country"] for r in g if r["origin_country"]})),
                      distinct(g, "factory"), len(g), one_digit(rates[0]), band(rates[0]), one_digit(mean),
                      one_digit(rates[0] - rate(prev[s])) if s in prev else None, levels.index(rate(everyone[s])) + 1))

    def overall(groups):
        return rate([r for g in groups.values() for r in g])

    def top(groups):
        return sum(rate(g) >= 95 for g in groups.values())

    now, old = overall(cur), overall(prev)
    cards = (one_digit(now), None if now is None or old is None else one_digit(now - old), top(cur),
             top(cur) - top(prev) if prev else None, low, sum(len(g) for g in cur.values()), len(cur))
    return sorted(table, key=lambda r: (r[0] is not None, r[0])), cards


@pytest.mark.parametrize("asked", REQUESTS, ids=str)
def test_dashboard(data, rules, asked):
    lines, rows = data
    table, cards = expected_dashboard(rows, asked)
    assert rows_of(dashboard.dashboard_suppliers(lines, Filters(MAY, **asked), rules)) == table
    got = dashboard.dashboard_cards(lines, Filters(MAY, **asked), rules).first()
    assert tuple(got[c] for c in ("compliance", "compliance_change", "top_count", "top_change", "follow_up_count",
                                  "total", "all")) == cards
    kept = [r for r in rows if passes(r, asked)]
    trend = []
    for i in range(12):
        here = of(kept, months_before(11 - i))
        split = [[r for r in here if region(r["origin_country"]) == x] for x in ("BD", "CN")]
        trend.append((months_before(11 - i), *(one_digit(rate(x)) for x in (*split, here))))
    assert rows_of(dashboard.rate_trend(lines, Filters(MAY, **asked), rules)) == trend


@pytest.mark.parametrize("asked", REQUESTS, ids=str)
def test_kpi_dashboard(data, rules, asked):
    lines, rows = data
    kept = [r for r in rows if passes(r, asked) and asked.get("region") in (None, region(r["origin_country"]))]
    shown = dashboard.kpi_dashboard(lines, Filters(MAY, **asked), rules)

    def change(now, before):
        return round((now - before) / before * 100) if before else None

    now, before = of(kept, MAY), of(kept, months_before(1))
    got = shown.cards.first()
    assert (got.lines, got.lines_change_pct) == (len(now), change(len(now), len(before)))
    assert (got.suppliers, got.suppliers_change) == (
        distinct(now, "supplier"), distinct(now, "supplier") - distinct(before, "supplier"))
    active = [sum(r["packaging_status"] not in (None, "Pending") for r in now if region(r["origin_country"]) == x)
              for x in ("BD", "CN")]
    assert (got.bd_lines, got.cn_lines) == tuple(active)
    assert (got.bd_avg, got.cn_avg) == tuple(math.ceil(n / 21) for n in active)
    span = [r for r in kept if month_of(r) and months_before(12) <= month_of(r) <= MAY]
    cells = []
    for country, g in by([r for r in span if r["origin_country"]], "origin_country").items():
        counts = [len(of(g, m)) or None for m in (MAY, months_before(1), months_before(12))]
        cells.append((country, *counts, region(country), round((counts[0] or 0) / len(now) * 100) if now else 0))
    assert rows_of(shown.countries) == sorted(cells)
    approvers = by([r for r in (*now, *before) if r["approved_by"]], "approved_by")
    assert rows_of(shown.approvers) == sorted(
        (a, len(of(g, MAY)), len(of(g, months_before(1))), change(len(of(g, MAY)), len(of(g, months_before(1)))))
        for a, g in approvers.items())


def test_lists(data, rules):
    lines, rows = data
    cur, prev, prev2 = (by(of(rows, months_before(i)), "supplier") for i in range(3))
    top = [(s, g) for s, g in cur.items() if rate(g) >= 95]
    top.sort(key=lambda x: (-rate(x[1]), -len(x[1]), x[0] is None, x[0]))
    got = rows_of(summary.top_suppliers(lines, MAY, rules), "sl", "supplier", "factory_count", "dest_po_count",
                  "reflected_lines", "rate")
    assert got == [(i, s, distinct(g, "factory"), distinct(g, "destination_po"), len(g), one_digit(rate(g)))
                   for i, (s, g) in enumerate(top, 1)]
    low = []
    for s, g in cur.items():
        old = [rate(x[s]) if s is not None and s in x else None for x in (prev, prev2)]
        rates = [rate(g), *(r for r in old if r is not None)]
        mean = sum(rates) / len(rates)
        if rates[0] < 40 and mean < 40:
            qty = [r["po_qty"] for r in g if r["po_qty"] is not None]
            low.append((mean, rates[0], s is None, s, sum(qty) if qty else None, old))
    low.sort(key=lambda x: x[:4])
    got = rows_of(summary.follow_up(lines, MAY, rules), "sl", "supplier", "qty", "rate", "prev_1", "prev_2",
                  "avg_3month")
    assert got == [(i, s, qty, one_digit(now), *map(one_digit, old), one_digit(mean))
                   for i, (mean, now, _, s, qty, old) in enumerate(low, 1)]


def test_series_and_comparison(data, rules):
    lines, rows = data
    expected = []
    for s, g in by([r for r in rows if month_of(r)], "supplier").items():
        first = min(month_of(r) for r in g)
        for i in range(11, -1, -1):
            month = months_before(i)
            if month >= first:
                here = of(g, month)
                approved = sum(r["packaging_status"] == "Approved" for r in here)
                expected.append((s, month, round(rate(here), 1) if here else 0.0,
                                 round(approved / len(here) * 100, 1) if here else 0.0))
    got = rows_of(supplier.supplier_series(lines.drop("density"), MAY, rules))
    assert got == sorted(expected, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    now = of(rows, MAY)
    table = by([r for m in kpi.table_months(MAY) for r in of(rows, m)], "origin_country")
    got = rows_of(kpi.month_comparison(lines, MAY, rules))
    assert got == sorted(((c, region(c), *(len(of(g, m)) or None for m in kpi.table_months(MAY)),
                           round(len(of(g, MAY)) / len(now) * 100)) for c, g in table.items()),
                         key=lambda r: (r[0] is not None, r[0] or ""))
    trend = rows_of(kpi.supplier_factory_trend(lines, MAY, rules), "month", "suppliers", "bd_suppliers", "cn_factories")
    assert trend == [(m, distinct(of(rows, m), "supplier"),
                      distinct([r for r in of(rows, m) if region(r["origin_country"]) == "BD"], "supplier"),
                      distinct([r for r in of(rows, m) if region(r["origin_country"]) == "CN"], "factory"))
                     for m in (months_before(i) for i in range(11, -1, -1))]
