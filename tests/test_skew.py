"""A third of all lines belongs to one supplier, factory, country, day and file; a tenth are exact copies. Results
equal a plain Python count, and no step gathers the hot group in one task."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from line_rows import MAY, frame, line, rows_of
from pyspark.sql import functions as F

from cartonwise.operators import kpi, rates, summary, supplier
from cartonwise.operators.facts import rollup
from cartonwise.operators.numbering import number_rows, sort_columns
from cartonwise.operators.transactions import ORDER, transactions_page
from cartonwise.sources.store import replace_files

LINES = 30_000


@pytest.fixture(scope="module")
def rows():
    source = random.Random(11)
    made = []
    for n in range(LINES):
        hot = n % 3 == 0
        copy = n % 10 == 0
        made.append(dict(
            supplier="HOT" if hot else f"S{source.randrange(400):03d}",
            factory="HOT" if hot else f"F{source.randrange(50):02d}",
            origin_country="China" if hot else source.choice(["India", "Turkey", "Vietnam", None]),
            handover_date=MAY if hot else dt.date(2026, source.randrange(1, 6), source.randrange(1, 28)),
            destination_po="PO" if copy else f"PO{source.randrange(LINES)}", kimball="K" if copy else str(n),
            compliance_status="Compliant" if copy or source.random() < .5 else "Non-compliant",
            packaging_status=source.choice(["Approved", "Pending"]) if not copy else "Approved", po_qty=1,
            source_file="hot.csv" if hot else f"{source.randrange(20)}.csv"))
    return made


@pytest.fixture(scope="module")
def lines(spark, rows):
    return frame(spark, [line(**r) for r in rows]).repartition(8).persist()


def in_may(rows):
    return [r for r in rows if r["handover_date"].month == 5]


def test_counts(lines, rows, rules):
    may = lines.where(F.col("handover_date") >= F.lit(MAY))
    expected = defaultdict(lambda: [set(), 0])
    for r in in_may(rows):
        expected[r["supplier"]][0].add(r["destination_po"])
        expected[r["supplier"]][1] += 1
    got = rows_of(supplier.line_details(may, "supplier"), "supplier", "dest_po_count", "reflected_lines")
    assert got == sorted((s, len(pos), n) for s, (pos, n) in expected.items())
    top = rows_of(summary.top_suppliers(lines, MAY, rules), "supplier", "sl")
    rate = {s: sum(r["compliance_status"] == "Compliant" for r in g) / len(g)
            for s, g in ((s, [r for r in in_may(rows) if r["supplier"] == s]) for s in expected)}
    order = sorted((s for s in rate if rate[s] * 100 >= 95), key=lambda s: (-rate[s], -expected[s][1], s))
    assert top == sorted((s, i) for i, s in enumerate(order, 1))
    levels = sorted(set(rate.values()), reverse=True)
    ranks = rows_of(rates.global_rank(may), "supplier", "rank", "total", "shared")
    shared = Counter(rate.values())
    assert ranks == sorted((s, levels.index(rate[s]) + 1, len(rate), shared[rate[s]] > 1) for s in rate)


def test_rollup_and_trend(lines, rows, rules):
    base = rollup(lines)
    assert base.agg(F.sum("lines")).first()[0] == LINES
    got = rows_of(kpi.supplier_factory_trend(base, MAY, rules), "month", "suppliers", "factories", "cn_suppliers")
    bd = {"India", "Turkey"}
    for month, suppliers, factories, cn in got:
        mine = [r for r in rows if r["handover_date"].replace(day=1) == month]
        assert (suppliers, factories, cn) == (
            len({r["supplier"] for r in mine}), len({r["factory"] for r in mine}),
            len({r["supplier"] for r in mine if r["origin_country"] not in bd}))


def test_pages_of_the_hot_supplier(lines, rows):
    hot = [r for r in in_may(rows) if r["supplier"] == "HOT"]
    blank = {c: None for c, _ in ORDER}
    ordered = sorted((tuple((v is None, "" if v is None else str(v)) for v in (blank | r).values()
                            ) for r in ({c: r.get(c) for c, _ in ORDER} for r in hot)))
    got, page, total = transactions_page(lines, "HOT", MAY, None, 57, 50)
    assert (page, total) == (57, len(hot))
    shown = [tuple((r[c] is None, "" if r[c] is None else str(r[c])) for c, _ in ORDER) for r in got.collect()]
    assert shown == ordered[56 * 50:57 * 50]


@pytest.fixture
def small_tasks(spark):
    """Tasks of some kilobytes, so that a small table is split as a large one would be."""
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k"}
    before = {name: spark.conf.get(name) for name in sizes}
    for name, size in sizes.items():
        spark.conf.set(name, size)
    yield
    for name, size in before.items():
        spark.conf.set(name, size)


def test_numbering_spreads_the_rows(small_tasks, spark, lines):
    order = sort_columns([("supplier", True), ("kimball", True)])
    numbered = number_rows(lines.select("supplier", "kimball"), order)
    written = numbered.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in written) == LINES and max(r["count"] for r in written) < LINES / 3
    assert numbered.agg(F.count_distinct("sl"), F.max("sl")).first() == (LINES, LINES)


def test_a_hot_file_is_written_by_several_tasks(small_tasks, spark, lines, tmp_path):
    replace_files(lines, str(tmp_path / "store"))
    assert len(list((tmp_path / "store" / "source_file=hot.csv").glob("*.parquet"))) > 1
    stored = spark.read.schema(lines.schema).parquet(str(tmp_path / "store"))
    assert rows_of(stored.groupBy("source_file").count()) == rows_of(lines.groupBy("source_file").count())
