import calendar
import datetime as dt

import pytest
from line_rows import rows_of
from pyspark.sql import functions as F

from cartonwise.functions import dates, numbers, regions, text


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).coalesce(1).select(*columns).collect()]


def test_rounding_follows_the_stored_double(spark):
    ratios = [(c / n * 100,) for n in (*range(1, 120), 400, 2000, 4000) for c in range(0, n + 1, max(1, n // 97))]
    ratios += [(k / 20,) for k in range(-400, 400)] + [(l / 1000 * 0.18 * 0.25,) for l in range(200, 700, 10)]
    got = values(spark, ratios, "x double", "x", *(numbers.rounded(F.col("x"), d) for d in (1, 2, 4)))
    assert [r for r in got if r[1:] != tuple(round(r[0], d) for d in (1, 2, 4))] == []
    assert values(spark, [(None,)], "x double", numbers.rounded(F.col("x"))) == [(None,)]


def test_percentages(spark):
    got = values(spark, [(1, 3), (0, 5), (3, 0)], "a int, b int", numbers.percent(F.col("a"), F.col("b")),
                 numbers.percent_change(F.col("a"), F.col("b")))
    assert got == [(1 / 3 * 100, -67), (0.0, -100), (None, None)]
    halves = values(spark, [(201, 200), (203, 200), (100, 80), (108, 127)], "a int, b int",
                    numbers.percent_change(F.col("a"), F.col("b")))
    assert halves == [(0,), (2,), (25,), (-15,)]


def test_bands_use_the_unrounded_rate(spark, rules):
    got = values(spark, [(69.96,), (70.0,), (40.0,), (39.99,), (59.9,), (60.0,), (None,)], "r double",
                 numbers.rate_band(F.col("r"), rules), numbers.heat_band(F.col("r"), rules))
    assert got[:6] == [("mid", "none"), ("high", "none"), ("mid", "mid"), ("low", "low"), ("mid", "mid"),
                       ("mid", "none")]
    assert got[6][1] == "none"


def test_carton_measures(spark):
    rows = [(1000.0, 1000.0, 1000.0, 12.0), (1000.0, None, 1000.0, 12.0), (1.0, 1.0, 1.0, 5.0),
            (210.0, 180.0, 250.0, None), (210.0, 180.0, 250.0, 7.0)]
    cbm = numbers.carton_volume(F.col("l"), F.col("w"), F.col("h"))
    got = values(spark, rows, "l double, w double, h double, u double", cbm, numbers.carton_density(F.col("u"), cbm))
    assert got == [(1.0, 12.0), (None, None), (0.0, None), (0.0095, None), (0.0095, round(7 / 0.0095, 2))]


def test_board_area_is_exact(spark):
    rows = [(3, 400, 300, 250), (7, 215, 330, 125)]
    got = values(spark, rows, "q int, l int, w int, h int",
                 numbers.board_area(*(F.col(c) for c in "qlwh")).cast("double") / numbers.BOARD_UNITS)
    expected = [q * ((l / 10 + 6) * (w / 10 + h / 10 + 4) * 2) / 10000 for q, l, w, h in rows]
    assert [g[0] for g in got] == pytest.approx(expected)


def test_month_arithmetic(spark):
    assert dates.shift_month(dt.date(2026, 1, 1), -1) == dt.date(2025, 12, 1)
    assert dates.shift_month(dt.date(2026, 12, 1), 1) == dt.date(2027, 1, 1)
    assert dates.shift_month(dt.date(2026, 6, 1), -18) == dt.date(2024, 12, 1)
    months = [(dt.date(y, m, 1),) for y in (2024, 2025, 2026) for m in range(1, 13)]
    month = F.col("m")
    got = values(spark, months, "m date", "m", dates.working_days(month, (4, 5)), dates.working_days(month, (5, 6)),
                 dates.calendar_days(month), dates.month_label(month))
    for m, bd, cn, days, label in got:
        span = [dt.date(m.year, m.month, d) for d in range(1, calendar.monthrange(m.year, m.month)[1] + 1)]
        assert (days, bd, cn) == (len(span), sum(d.weekday() not in (4, 5) for d in span),
                                  sum(d.weekday() not in (5, 6) for d in span))
        assert label == f"{calendar.month_abbr[m.month]} '{m.year % 100:02d}"


@pytest.mark.parametrize("first, count", [((2020, 5, 9), 12), ((2026, 3, 31), 3), ((2026, 5, 2), 1),
                                          ((2026, 6, 1), 0), (None, 0)])
def test_month_grid(spark, first, count):
    rows = [(dt.date(*first) if first else None,)]
    (grid,), = values(spark, rows, "d date", dates.month_grid(F.col("d"), dt.date(2026, 5, 1), 12))
    assert (grid or []) == [dates.shift_month(dt.date(2026, 5, 1), -i) for i in reversed(range(count))]


def test_text(spark):
    cells = [("  a b\t ",), ("nan",), (" nan ",), ("None",), ("",), (None,), ("\u00a0x\u2003\r\n",)]
    got = values(spark, cells, "c string", text.clean_text(F.col("c")))
    assert [g[0] for g in got] == ["a b", None, None, "None", "", None, "x"]
    assert text.like_contains(r"50%_a\b") == r"%50\%\_a\\b%"
    emails = values(spark, [("a@x.com; b@x.com,,a@x.com",), (" ; ",), (None,)], "c string",
                    text.split_emails(F.col("c")))
    assert [e[0] for e in emails] == [["a@x.com", "b@x.com"], [], None]
    assert values(spark, [('A/B: "C" <D>\\|?* & co',)], "c string", text.file_safe(F.col("c"))) == [
        ("A_B_ _C_ _D_____ & co",)]
    assert values(spark, [(400, None, 25)], "l int, w int, h int",
                  text.carton_size(F.col("l"), F.col("w"), F.col("h"))) == [("400×0×25",)]
    joined = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("b", None)], "k string, v string")
    assert rows_of(joined.groupBy("k").agg(text.joined("v"))) == [("a", "x, y"), ("b", None)]


def test_regions(spark, rules):
    got = values(spark, [("India",), ("China",), (None,), ("",)], "c string",
                 regions.country_region(F.col("c"), rules))
    assert [g[0] for g in got] == ["BD", "CN", "CN", "CN"]
    pairs = [("all", "India"), ("all", " Turkey "), ("all", None), ("mixed", "India"), ("mixed", "China"),
             ("none", None), ("blank", "")]
    grouped = spark.createDataFrame(pairs, "s string, c string").groupBy("s").agg(
        regions.supplier_region(F.col("c"), rules).alias("r"),
        regions.supplier_region(F.col("c"), rules, "CN").alias("folder"),
        regions.supplier_region(F.col("c"), rules, skip_blank=True).alias("dashboard"))
    assert rows_of(grouped) == [("all", "BD", "BD", "BD"), ("blank", "CN", "CN", "BD"), ("mixed", "CN", "CN", "CN"),
                                ("none", "BD", "CN", "BD")]
