"""Every query against its SQL, and the shape of every plan."""

import re

import pytest

import __spark_entry__ as entry
from cartonwise import catalog, oracle
from cartonwise.catalog import MONTH, month_report
from cartonwise.sources.tables import read_lines
from parity import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.QUERIES, oracle.oracle_sql()
@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in plan
    assert differences(df, tables, SQL[name]) == []


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["sl", "supplier"]


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"FileScan parquet \[([^\]]*)\].*?(\w+)\.parquet", plan)


def test_only_needed_tables_and_columns_are_read(spark):
    lines = read_lines(spark, FOLDER, "handover_date", "supplier", "compliance_status")
    read = {name: {c.split("#")[0] for c in columns.split(",")} for columns, name in scans(lines)}
    assert read == {"lineitem": {"l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_linenumber",
                                 "l_linestatus"} & read["lineitem"], "supplier": {"s_suppkey", "s_name"}}
    assert "orders" not in read and "part" not in read


def executed(df):
    """The lines of the plan that ran, subqueries included, without the plans that adaptive execution started from."""
    df.collect()
    kept, skipped = [], None
    for row in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        depth = len(row) - len(row.lstrip(" :+-"))
        if skipped is not None and depth >= skipped:
            continue
        skipped = depth if "== Initial Plan ==" in row else None
        kept.append(row)
    return kept


@pytest.mark.parametrize("name, times", [("top_suppliers", 0), ("follow_up", 0),  # lists that are kept when they are built
                                         ("country_bars", 1), ("supplier_directory", 1),
                                         ("country_order", 2), ("yearly_search", 2)])  # grids look for the first day once more
def test_numbered_lists_read_the_lines_once(spark, name, times):
    assert sum("FileScan parquet [l_" in row for row in executed(QUERIES[name](spark, FOLDER))) == times


def test_month_filter_reaches_the_scan(spark, capsys):
    QUERIES["supplier_kpis"](spark, FOLDER).explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate,2001-10-01.*LessThan\(l_shipdate,2001-11-01",
                     plan)


def test_month_report_over_the_tables(spark):
    tables = month_report(spark, FOLDER)
    assert tables["sources"].first().total_suppliers == 10 and MONTH.year == 2001
