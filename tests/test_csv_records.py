"""CSV files in many splits against readers of whole files."""

import csv
import io
import random

import pytest

from tessera.sources import csv_records as R
from tessera.sources.files import read_entities


@pytest.fixture
def small_splits(spark):
    """Splits of some bytes, each a task of its own."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


CELLS = ["a", "", "Ромашка", " b ", 'say "no"', "one,two", "two\nlines", "\n", "crlf\r\nin a cell", '"', '""', 'x"y', "long " * 30, '","', '\n"\n,']


def written(r, rows, end, every):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_ALL if every else csv.QUOTE_MINIMAL)
    writer.writerow(["id", "name", "more"])
    for row in rows:
        if r.random() < 0.1:
            out.write(end)
        writer.writerow(row)
    return out.getvalue()


@pytest.mark.parametrize("seed", range(4))
def test_rows_of_many_splits_equal_the_csv_module(spark, tmp_path, small_splits, seed):
    r = random.Random(seed)
    rows = [[str(k), r.choice(CELLS), r.choice(CELLS)] for k in range(40)]
    text = written(r, rows, ["\n", "\r\n"][seed % 2], seed % 3 == 0)
    path = tmp_path / "list.csv"
    path.write_bytes(("﻿" if seed % 2 else "").encode() + text.encode())
    want = list(csv.reader(io.StringIO(text, newline="")))
    want = [x for x in want if x][1:]
    for size in (40, 1 << 20):
        small_splits(size)
        got = sorted(R.read_csv(spark, str(path)).collect(), key=lambda x: x["row_no"])
        assert [(x["row_no"], x["id"], x["name"] or "", x["more"] or "") for x in got] == [(k + 1, *row) for k, row in enumerate(want)]
        assert R.lines_of(spark, str(path)).rdd.getNumPartitions() >= min(20, len(text) // size)


def test_transitions_equal_a_plain_automaton():
    def plain(line, inside):
        state = "in" if inside else "start"
        for c in line:
            if state == "in":
                state = "quote" if c == '"' else "in"
            elif state == "quote" and c == '"':
                state = "in"
            elif c == ",":
                state = "start"
            elif state == "start" and c == '"':
                state = "in"
            else:
                state = "rest"
        return state == "in"

    r = random.Random(2)
    for _ in range(20_000):
        line = "".join(r.choice('a,""\r') for _ in range(r.randint(0, 12)))
        for inside in (False, True):
            assert R.ends_inside(line, inside) == plain(line, inside), (line, inside)
    long = '"' + 'a""' * 200_000 + '",' + "b," * 200_000 + '"'
    assert R.ends_inside(long, False) and not R.ends_inside(long[:-1], False)


def test_quotes_inside_plain_cells_open_nothing(spark, tmp_path, small_splits):
    path = tmp_path / "q.csv"
    path.write_text('id,name\n1,5" pipe\n2,a "b\n3,"c\nd"\n4,e')
    got = {x["row_no"]: x["name"] for x in R.read_csv(spark, str(path)).collect()}
    assert got == {1: '5" pipe', 2: 'a "b', 3: "c\nd", 4: "e"}


def test_several_files_are_numbered_through(spark, tmp_path, small_splits):
    folder = tmp_path / "lists"
    folder.mkdir()
    for k, rows in enumerate((["1,a\n", '2,"b\nb"\n'], [], ["3,c\n", "\n", "4,\n", "5,d"])):
        (folder / f"part-{k}.csv").write_text("id,name\n" + "".join(rows))
    got = sorted((x.row_no, x.entity_id, x.name) for x in read_entities(spark, str(folder)).collect())
    assert got == [(1, "1", "a"), (2, "2", "b\nb"), (3, "3", "c"), (5, "5", "d")]


def test_what_is_no_list(spark, tmp_path, small_splits):
    (tmp_path / "open.csv").write_text('id,name\n1,"a\n2,b\n' * 9)
    with pytest.raises(ValueError, match="not closed"):
        R.read_records(spark, str(tmp_path / "open.csv"))
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no column"):
        read_entities(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "head.csv").write_text("Name\n")
    assert read_entities(spark, str(tmp_path / "head.csv")).collect() == []
    two = tmp_path / "two"
    two.mkdir()
    (two / "a.csv").write_text("name\nx\n")
    (two / "b.csv").write_text("name,id\nx,1\n")
    with pytest.raises(ValueError, match="several headers"):
        read_entities(spark, str(two))
