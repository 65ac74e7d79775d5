"""Hash trees over byte ranges against a plain recursion over the bytes."""

from __future__ import annotations

import hashlib
import random

import pytest

from deskwright.sources.byte_tree import byte_tree, changed_ranges, file_digests

SIZE, FANOUT = 10, 3


def plain_levels(data: bytes) -> list[list[str]]:
    """Digests of the levels of a file, leaves first."""

    def sha(part: bytes) -> str:
        return hashlib.sha256(part).hexdigest()

    levels = [[sha(data[i : i + SIZE]) for i in range(0, len(data), SIZE)]]
    while len(levels[-1]) > 1:
        below = levels[-1]
        groups = [below[i : i + FANOUT] for i in range(0, len(below), FANOUT)]
        levels.append([sha("".join(group).encode()) for group in groups])
    return levels


def tree_of(spark, folder):
    return byte_tree(spark, str(folder), SIZE, FANOUT)


def name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


@pytest.fixture
def files(tmp_path) -> dict[str, bytes]:
    """Lengths at and around borders of ranges and of nodes; a name with a space and a percent sign."""
    rng = random.Random(5)
    lengths = [0, 1, 9, 10, 11, 29, 30, 31, 89, 90, 91, 270, 271, 1234]
    made = {f"f {n}%.bin": rng.randbytes(n) for n in lengths}
    for file, data in made.items():
        (tmp_path / file).write_bytes(data)
    return made


def test_every_node_equals_a_plain_tree(spark, tmp_path, files):
    wanted = {
        (file, len(data), len(levels) - 1, level, number, digest)
        for file, data in files.items()
        if data
        for levels in [plain_levels(data)]
        for level, digests in enumerate(levels)
        for number, digest in enumerate(digests)
    }
    tree = tree_of(spark, tmp_path)
    found = [(name(r["path"]), *r[1:]) for r in tree.collect()]
    assert len(found) == len(set(found)) and set(found) == wanted
    tops = {name(r["path"]): r["digest"] for r in file_digests(tree).collect()}
    assert tops == {file: plain_levels(data)[-1][0] for file, data in files.items() if data}


def test_changed_ranges_are_found_again(spark, tmp_path, files):
    before = tree_of(spark, tmp_path)
    assert changed_ranges(before, tree_of(spark, tmp_path), SIZE, FANOUT).count() == 0

    def write(file: str, data: bytes) -> None:
        (tmp_path / file).write_bytes(data)

    long, full, short = (files[f"f {n}%.bin"] for n in (1234, 270, 11))
    # One byte at either side of a border; a file one range longer, whose tree is a level higher;
    # one that loses its last range; one that is emptied; a new one and one that goes.
    write("f 1234%.bin", long[:609] + bytes([long[609] ^ 1, long[610] ^ 1]) + long[611:])
    write("f 270%.bin", full + b"x")
    write("f 11%.bin", short[:10])
    write("f 31%.bin", b"")
    write("new.bin", b"y" * 15)
    (tmp_path / "f 29%.bin").unlink()
    found = changed_ranges(before, tree_of(spark, tmp_path), SIZE, FANOUT).collect()
    assert sorted((name(r["path"]), r["start"], r["change"]) for r in found) == [
        ("f 11%.bin", 10, "removed"),
        ("f 1234%.bin", 600, "changed"),
        ("f 1234%.bin", 610, "changed"),
        ("f 270%.bin", 270, "added"),
        ("f 29%.bin", 0, "removed"),
        ("f 29%.bin", 10, "removed"),
        ("f 29%.bin", 20, "removed"),
        ("f 31%.bin", 0, "removed"),
        ("f 31%.bin", 10, "removed"),
        ("f 31%.bin", 20, "removed"),
        ("f 31%.bin", 30, "removed"),
        ("new.bin", 0, "added"),
        ("new.bin", 10, "added"),
    ]


def test_sizes_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        byte_tree(spark, str(tmp_path), 0)
    with pytest.raises(ValueError):
        byte_tree(spark, str(tmp_path), 10, 1)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "one.bin").write_bytes(b"z" * 4_000)
    tree = byte_tree(spark, str(tmp_path), 10, 1_000)
    leaves = tree.where("level = 0")
    assert leaves.count() == 400
    assert len(leaves.inputFiles()) > 10


def test_short_ranges_share_tasks(spark, tmp_path):
    data = random.Random(7).randbytes(40_000)
    (tmp_path / "one.bin").write_bytes(data)
    leaves = byte_tree(spark, str(tmp_path), 2, 256).where("level = 0")
    # 20,000 ranges of two bytes are no work for 2,500 tasks.
    assert len(leaves.inputFiles()) <= 8 * spark.sparkContext.defaultParallelism
    found = sorted(tuple(r) for r in leaves.select("number", "digest").collect())
    wanted = [hashlib.sha256(data[i : i + 2]).hexdigest() for i in range(0, len(data), 2)]
    assert found == list(enumerate(wanted))
