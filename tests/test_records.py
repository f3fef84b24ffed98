"""Large CSV files cut into records by many tasks, against Spark's own reader, which reads each file in one."""

import csv
import io
import random
import re

import pytest
from line_rows import rows_of
from test_loading import BASE, write

from cartonwise.sources import exports
from cartonwise.sources.records import read_records
from cartonwise.sources.store import LineStore

SCHEMA = "a string, b string, c string"


@pytest.fixture
def small_ranges(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield cut
    for key, value in before.items():
        spark.conf.set(key, value)


def whole(spark, paths):
    return rows_of(exports._reader(spark).schema(SCHEMA).csv(paths))


def split(spark, paths):
    found = read_records(spark, paths)
    rows = found.rows.selectExpr(f"from_csv(value, '{SCHEMA}', map('quote', '\"', 'escape', '\"')) as x").select("x.*")
    return rows_of(rows), found.irregular


def cell(own):
    return "".join(own.choice(["x", "yz", " ", ",", '"', "\n", "", "é", "1"]) for _ in range(own.randrange(6)))


@pytest.mark.parametrize("seed, size, ends", [(1, 40, "\n"), (2, 7, "\n"), (3, 64, "\r\n"), (4, 1000, "\n"), (5, 90, "\n")])
def test_records_are_those_of_the_whole_file(spark, tmp_path, small_ranges, seed, size, ends):
    own, paths = random.Random(seed), []
    for number in range(3):
        text = io.StringIO()
        out = csv.writer(text, lineterminator=ends, quoting=own.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
        out.writerow(["a", "b\nof two lines" if number == 1 else "b", "c"])
        for row in range(120):
            cells = [f"r{row}", cell(own), cell(own)]
            if own.random() < 0.03:
                cells[1] = "\n".join("line, " * own.randrange(9) for _ in range(40))
            out.writerow(cells)
        path = tmp_path / f"file {number} (ü%).csv"
        path.write_text(text.getvalue() if own.random() < 0.5 else text.getvalue().rstrip(ends), encoding="utf-8", newline="")
        paths.append(str(path))
    expected = whole(spark, paths)
    small_ranges(size)
    got, irregular = split(spark, paths)
    assert irregular == set() and got == expected


@pytest.mark.parametrize("bad", ['r,5" pipe,z\n', 'r,5" pipe,"open\nclosed"\n', 'r,"closed" here,z\n', 'r,"never closed\nand on\n', 'r,"a\nb"c,d\n', 'r,"x ""y" z",q\n'])
def test_files_with_quotes_elsewhere_are_read_whole(spark, tmp_path, small_ranges, bad):
    good, odd = tmp_path / "good.csv", tmp_path / "odd.csv"
    lines = "".join(f'{i},"two\nlines",c{i}\n' for i in range(30))
    good.write_text("a,b,c\n" + lines)
    odd.write_text("a,b,c\n" + lines + bad + (lines if "never" not in bad else ""))
    small_ranges(50)
    got, irregular = split(spark, [str(good), str(odd)])
    assert [f.rsplit("/", 1)[1] for f in irregular] == ["odd.csv"] and len(got) == 30


def test_a_large_export_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    rows = [BASE | {"Kimball": str(i), "Description": f'line one of {i}\nline "two", of it' if i % 3 else "plain"} for i in range(400)]
    path = write(tmp_path / "may 1-15 (large).csv", rows)
    odd = write(tmp_path / "odd.csv", rows[:50])
    with open(odd, "a", encoding="utf-8") as file:
        file.write('5" pipe,M\n')
    few = write(tmp_path / "few.csv", rows[:3])
    plain = rows_of(LineStoreRows(spark, tmp_path / "whole", [path, odd, few]))
    small_ranges(2000)
    layouts = {p: exports.layout_of(spark, p) for p in (path,)}
    cells = exports.read_exports(spark, layouts, split_bytes=1000)
    assert cells.count() == 400 and cells.rdd.getNumPartitions() > 5
    assert rows_of(LineStoreRows(spark, tmp_path / "split", [path, odd, few], split_bytes=1000)) == plain and len(plain) == 454


def LineStoreRows(spark, path, paths, **options):
    store = LineStore(spark, str(path), **options)
    assert {r.status for r in store.load(paths).collect()} == {"Loaded"}
    return store.read().select("source_file", "kimball", "description", "supplier", "carton_type", "handover_date")


def test_no_records(spark, tmp_path, small_ranges):
    path = tmp_path / "empty.csv"
    path.write_text("a,b,c\n")
    small_ranges(10)
    assert split(spark, [str(path)]) == ([], set())
    path.write_text("a,b,c\n\n\r\n1,2,3\n\n")
    assert split(spark, [str(path)])[0] == [("1", "2", "3")]


def test_lines_stay_with_the_tasks_that_read_them(spark, tmp_path, small_ranges):
    """Only pieces of the records that reach over ranges are shuffled, so one grouping besides the ranges' windows."""
    path = write(tmp_path / "large.csv", [BASE | {"Kimball": str(i), "Description": f"line one of {i}\nline two"} for i in range(300)])
    small_ranges(1500)
    rows = read_records(spark, [path]).rows
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.count() == 300 and plan.count("Aggregate") == 1 and not re.search("Window|Join|Repartition.*true|Rebalance", plan)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_irregular_files_are_told_by_every_line(spark, tmp_path, small_ranges, seed):
    """Random quotes: rows are those of the whole file, or the file is named."""
    own, paths = random.Random(seed), []
    for number in range(12):
        path = tmp_path / f"{number}.csv"
        lines = [",".join(own.choice(['"a"', "b", '""', '"c\nd"', '"e""f"', "", '"""g"""']) for _ in range(3)) for _ in range(40)]
        if number % 2:
            lines[own.randrange(40)] = own.choice(['x,5" pipe,z', 'x,"y"z,w', 'x,y "z",w', '"x" ,y,z'])
        path.write_text("a,b,c\n" + "\n".join(lines) + "\n")
        paths.append(str(path))
    small_ranges(own.choice([20, 60, 200]))
    got, irregular = split(spark, paths)
    odd = {p for p in paths if int(p.rsplit("/", 1)[1][:-4]) % 2}
    assert {f.rsplit("/", 1)[1] for f in irregular} == {p.rsplit("/", 1)[1] for p in odd}
    assert got == whole(spark, [p for p in paths if p not in odd])
