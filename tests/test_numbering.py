import datetime as dt
import random

import pytest
from line_rows import rows_of

from cartonwise.operators.numbering import number_list, number_names, number_rows, page_of, sort_columns

ORDER = [("a", False), ("b", True)]


@pytest.fixture(scope="module")
def data(spark):
    source = random.Random(5)
    rows = [(source.choice([1.0, 2.0, 3.0, 3.0, None]), f"n{i:05d}") for i in range(5000)]
    return spark.createDataFrame(rows, "a double, b string").repartition(6), rows


def expected(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, -(r[0] or 0), r[1]))


def test_number_rows_is_the_global_position(data):
    df, rows = data
    got = rows_of(number_rows(df, sort_columns(ORDER)))
    assert got == [(i, *r) for i, r in enumerate(expected(rows), start=1)]


def test_number_list_is_the_same(data):
    df, rows = data
    got = rows_of(number_list(df, ORDER[0], ORDER[1:]))
    assert got == [(i, *r) for i, r in enumerate(expected(rows), start=1)]


@pytest.mark.parametrize("order", [[("b", True)], [("b", False), ("a", True)], ORDER, [("a", True), ("b", False)]])
@pytest.mark.parametrize("ranges", [1, 7, 200])
def test_number_names_is_the_same(data, order, ranges):
    df, _ = data
    got = rows_of(number_names(df, order, ranges=ranges))
    assert got == rows_of(number_rows(df, sort_columns(order)))


def test_nothing_runs_before_the_list_is_read(data, monkeypatch):
    df, _ = data
    monkeypatch.setattr(type(df), "collect", lambda self: pytest.fail("ran"))
    monkeypatch.setattr(type(df), "count", lambda self: pytest.fail("ran"))
    number_names(df, ORDER), number_list(df, ORDER[0], ORDER[1:])


def test_number_names_of_nothing(data):
    assert number_names(data[0].where("b is null"), ORDER).count() == 0


def test_number_rows_of_nothing(data):
    assert number_rows(data[0].where("b is null"), sort_columns(ORDER)).count() == 0


@pytest.mark.parametrize("page, shown", [(1, 1), (2, 2), (55, 55), (99, 99), (100, 100), (500, 100), (-3, 1)])
def test_pages(data, page, shown):
    df, rows = data
    got, number, total = page_of(df, ORDER, page, 50)
    assert (number, total) == (shown, 5000)
    assert [tuple(r) for r in got.collect()] == expected(rows)[(shown - 1) * 50:shown * 50]


KEYS = [("day", True), ("at", False), ("amount", True), ("name", False), ("same", True)]


@pytest.fixture(scope="module")
def mixed(spark):
    """A third of the rows share most of their key; nulls, NaN, exact copies."""
    source = random.Random(9)
    day, rows = dt.date(2026, 5, 1), []
    for i in range(4000):
        hot = i % 3 == 0
        rows.append((day if hot else day + dt.timedelta(source.randrange(-3, 3)) if source.random() > 0.1 else None,
                     None if source.random() < 0.1 else dt.datetime(2026, 5, 1) + dt.timedelta(hours=0 if hot else source.randrange(9)),
                     source.choice([None, float("nan"), 1.5, -2.0]) if not hot else 1.5,
                     f"né{source.randrange(2000 if hot else 50)}", "x"))
    df = spark.createDataFrame(rows, "day date, at timestamp, amount double, name string, same string").repartition(5)
    return df, [tuple(r) for r in df.coalesce(1).orderBy(*sort_columns(KEYS)).collect()]


@pytest.mark.parametrize("page", [1, 2, 40, 57, 100, 133, 160, 200])
@pytest.mark.parametrize("sorted_at_once, values", [(25, 5), (100, 64), (5000, 64)])
def test_pages_by_ranges(mixed, page, sorted_at_once, values):
    df, ordered = mixed
    got, number, total = page_of(df, KEYS, page, 20, sorted_at_once, values)
    assert (number, total) == (page, 4000)
    assert str([tuple(r) for r in got.collect()]) == str(ordered[(page - 1) * 20:page * 20])


def test_a_page_sorts_its_range_only(mixed):
    df, _ = mixed
    got, _, _ = page_of(df, KEYS, 100, 20, 50, 16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan or "TakeOrderedAndProject" in plan
    assert "TakeOrderedAndProject" in plan


def test_last_page_may_be_short(data):
    df, rows = data
    got, number, _ = page_of(df, ORDER, 99, 999)
    assert number == 6 and [tuple(r) for r in got.collect()] == expected(rows)[4995:]


def test_page_of_nothing(data):
    got, number, total = page_of(data[0].where("b is null"), ORDER, 4, 50)
    assert (got.count(), number, total) == (0, 1, 0)
