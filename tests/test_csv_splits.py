"""CSV read split by split against the reader that takes a file in one task."""

from __future__ import annotations

import random

import pytest

from deskwright.sources import readers
from deskwright.sources.csv_splits import ends_inside, read_lines
from deskwright.sources.readers import IndexedExport, read_tickets

SMALL = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def plain_end(line, inside):
    """By characters: f field start, u unquoted, q quoted, e a quote inside quotes."""
    state = "q" if inside else "f"
    for c in line:
        if state == "e":
            state = "q" if c == '"' else "f" if c == "," else "u"
        elif state == "q":
            state = "e" if c == '"' else "q"
        elif c == ",":
            state = "f"
        else:
            state = "q" if state == "f" and c == '"' else "u"
    return state == "q"


def test_transitions_of_lines_equal_a_plain_automaton():
    rng = random.Random(2)
    for _ in range(50_000):
        line = "".join(rng.choices('",ab \r', k=rng.randint(0, 10)))
        for inside in (False, True):
            assert ends_inside(line, inside) == plain_end(line, inside), (line, inside)
    assert ends_inside('"' + '""' * 500_000, False) and not ends_inside("," * 500_000 + '"', True)


def random_csv(rng, rows, line_end):
    def field():
        kind = rng.random()
        text = "".join(rng.choices(["a", "é", " ", "1", "\n", ",", '""', "\n\n", "x" * 40], k=rng.randint(0, 6)))
        if kind < 0.5:
            return '"' + text.replace("\n", line_end) + '"'
        if kind < 0.6:
            return 'in"side'
        return text.replace("\n", "").replace(",", "").replace('"', "")

    lines = ["ticket_id,title,status"]
    for i in range(rows):
        lines.append(",".join([str(i), *[field() for _ in range(rng.choice([1, 2, 2, 2, 3]))]]))
        if rng.random() < 0.1:
            lines.append("")
    return line_end.join(lines)


def listed(rows):
    rows = rows.select("row_number", "data.*", "read_error").collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_splits_equal_whole_files(spark, tmp_path, small_splits, monkeypatch, line_end):
    rng = random.Random(5)
    (tmp_path / "in").mkdir()
    for name in "abc":
        text = random_csv(rng, 80, line_end) + (line_end if name == "a" else "")
        mark = "\ufeff" if name == "b" else ""
        (tmp_path / "in" / f"{name}.csv").write_bytes((mark + text).encode())
    path = str(tmp_path / "in")
    found = read_tickets(spark, path, "csv")
    assert readers._has_long_files(spark, path)
    got = listed(found)
    export = IndexedExport(spark, path, str(tmp_path / "index"), "csv")
    part = listed(export.rows(100, 110))
    monkeypatch.setattr(readers, "_has_long_files", lambda *_: False)
    whole = listed(read_tickets(spark, path, "csv"))
    assert [r[0] for r in got] == list(range(1, 241)) and got == whole
    assert part == whole[100:110]


def test_a_record_over_many_splits_and_an_open_one(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i} of one value, with a comma" for i in range(100))
    path = tmp_path / "in.csv"
    path.write_text(f'ticket_id,title\n1,"{long}"\n2,two\n\n3,"never closed\nto the end\n', encoding="utf-8")
    rows = read_tickets(spark, str(path)).orderBy("row_number").collect()
    assert [(r["data"]["ticket_id"], r["data"]["title"]) for r in rows[:2]] == [("1", long), ("2", "two")]
    assert rows[2]["data"]["title"].startswith("never closed\nto the end") and len(rows) == 3


def test_small_splits_share_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "in.csv"
    records = [f'{i},"title {i},\nin ""two"" lines"' for i in range(800)]
    path.write_text("\n".join(["ticket_id,title", *records]) + "\n", encoding="utf-8")
    cores = spark.sparkContext.defaultParallelism
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 10 * cores
    assert read_lines(spark, str(path)).rdd.getNumPartitions() <= 4 * cores
    rows = read_tickets(spark, str(path)).orderBy("row_number").collect()
    assert [(r["row_number"], *r["data"]) for r in rows] == [
        (i + 1, str(i), f'title {i},\nin "two" lines') for i in range(800)
    ]
