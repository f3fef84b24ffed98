"""Rows of the line table and results as rows, for several test files."""

import datetime as dt

from cartonwise.schema import LINES

# Supplier, factory, country, then (lines, compliant ones) in April and in May.
GROUPS = [
    ("Aurum", "A1", "India", (4, 1), (5, 4)), ("Aurum", "A2", "Pakistan", (2, 2), (3, 3)),
    ("Borea", "B1", "China", (8, 6), (8, 2)), ("Borea", "B2", "India", (0, 0), (2, 1)),
    ("Cedar", "C1", "Portugal", (5, 5), (7, 7)), ("Delta", "D1", "China", (6, 1), (9, 2)),
    ("Echo", "E1", "Turkey", (3, 0), (4, 2)),
]
APRIL, MAY = dt.date(2026, 4, 1), dt.date(2026, 5, 1)


def line(**values):
    """A row of the line table; columns not given are null."""
    return tuple(values.get(f.name) for f in LINES.fields)


def frame(spark, rows):
    return spark.createDataFrame(rows, LINES)


def spec_rows(month):
    """Group by group, lines come on every third day from the 2nd on; the compliant ones are the last. Three lines share an
    order. Carol approves what comes from China, Dave the rest; a group's first line in May is escalated and unapproved."""
    rows = []
    for supplier, factory, country, *counts in GROUPS:
        lines, compliant = counts[month == MAY]
        for number in range(lines):
            open_ = month == MAY and number == 0
            rows.append(line(
                supplier=supplier, factory=factory, origin_country=country, destination_po=f"{factory}-{number // 3}",
                kimball=f"{factory}{number}", handover_date=month.replace(day=2 + 3 * number),
                compliance_status="Compliant" if number >= lines - compliant else "Non-compliant", source_file="spec.csv",
                packaging_status="Escalated" if open_ else "Approved",
                approved_by=None if open_ else "carol" if country == "China" else "dave"))
    return rows


def rows_of(df, *columns):
    """Rows as sorted tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))
