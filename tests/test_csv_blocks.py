"""Quoted line breaks in CSV files that are read in several blocks."""

import csv
import io
import random

import pytest

from foliospark.sources import csvfiles

COLUMNS = ["id", "note", "tail"]


def rows_of(draw, n):
    bits = ["a", '"', ",", "\n", "\r\n", " ", "x" * 30, "\n\n", '""', 'say "no", \n', "é"]
    return [(str(i), "v" + "".join(draw.choice(bits) for _ in range(draw.randint(0, 6))) + "w", f"t{i}") for i in range(n)]


def write(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([COLUMNS, *rows])
    path.write_bytes(out.getvalue().encode())


@pytest.fixture
def small_blocks(spark):
    names = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("150", "1")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_blocks_against_the_csv_module(spark, tmp_path, small_blocks, end):
    draw = random.Random(5)
    expected = {f"f{i}.csv": rows_of(draw, n) for i, n in enumerate((60, 1, 0, 25))}
    expected["long.csv"] = [("0", "v" + "line\n" * 200 + "w", "t0"), ("1", "v,w", "t1"), ("2", 'v\n"\nw', "t2")]
    for name, rows in expected.items():
        write(tmp_path / name, rows, end)
    (tmp_path / "open.csv").write_text('id,note,tail\n1,plain " quote 5",x\n\n2,"never closed\n3,y,z\n')
    found = csvfiles.number_rows(csvfiles.read_csv(spark, str(tmp_path), COLUMNS, multi_line=True)).collect()
    for name, rows in expected.items():
        got = sorted((r["row_number"], *(r[c] for c in COLUMNS)) for r in found if r["_file"].endswith("/" + name))
        assert [g[1:] for g in got] == rows
        assert [g[0] for g in got] == list(range(1, len(rows) + 1))
    assert len({r["_block"] for r in found if r["_file"].endswith("f0.csv")}) > 3
    assert [r["note"] for r in sorted((r for r in found if r["_file"].endswith("open.csv")), key=lambda r: r["row_number"])][0] == 'plain " quote 5"'


def test_rows_are_numbered_from_one_without_rejected_ones(spark, tmp_path, small_blocks):
    write(tmp_path / "a.csv", [(str(i) if i % 3 else "bad", "v\nw", "t") for i in range(40)])
    schema = spark.createDataFrame([], "id int, note string, tail string").schema
    rows = csvfiles.typed_rows(csvfiles.read_csv(spark, str(tmp_path), COLUMNS, multi_line=True), schema)
    found = csvfiles.number_rows(csvfiles.accepted(rows)).orderBy("row_number").collect()
    assert [r["id"] for r in found] == [i for i in range(40) if i % 3]
    assert [r["row_number"] for r in found] == list(range(1, len(found) + 1))


def test_text_is_not_shuffled(spark, tmp_path):
    write(tmp_path / "a.csv", [("1", "v\nw", "t")])
    df = csvfiles.quoted_records(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
