"""Digest trees over byte ranges."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from markfield.sources import ranges as R
from markfield.sources.files import listing
from markfield.sources.packs import write_packed
from markfield.sources.ranges import changed_ranges, range_digests, tree_roots


def root_of(data, size, fan):
    level = [hashlib.sha256(data[at:at + size]).digest() for at in range(0, max(len(data), 1), size)]
    while len(level) > 1:
        groups = [level[at:at + fan] for at in range(0, len(level), fan)]
        level = [group[0] if len(group) == 1 else hashlib.sha256(b"".join(group)).digest() for group in groups]
    return level[0].hex()


def test_roots_and_changed_bytes(spark, tmp_path):
    files = {"empty": b"", "one": b"x" * 10, "large": bytes(range(256)) * 40, "exact": b"ab" * 50}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    before = range_digests(listing(spark, str(tmp_path)), 100)
    assert before.filter("relpath = 'large'").count() == 103
    for fan in (2, 7, 1_024):
        found = {r.relpath: (r.bytes, r.root) for r in tree_roots(before, fan).collect()}
        assert found == {name: (len(data), root_of(data, 100, fan)) for name, data in files.items()}
    assert found["one"][1] == hashlib.sha256(files["one"]).hexdigest()
    hurt = bytearray(files["large"])
    hurt[5_555] ^= 1
    (tmp_path / "large").write_bytes(hurt)
    (tmp_path / "one").unlink()
    (tmp_path / "exact").write_bytes(files["exact"] + b"c")
    after = range_digests(listing(spark, str(tmp_path)), 100)
    assert {tuple(r) for r in changed_ranges(before, after).collect()} == {("large", 55, 5_500, 100), ("one", 0, 0, 10), ("exact", 1, 100, 1)}


def test_ranges_of_one_file_are_many_tasks(spark, tmp_path):
    (tmp_path / "large").write_bytes(b"z" * 100_000)
    assert range_digests(listing(spark, str(tmp_path)), 1_000).selectExpr("input_file_name() AS f").distinct().count() > 4


def test_ranges_of_packed_files(spark, tmp_path):
    """Ranges that end at, before and beyond a stretch, a pack or a block read at once, beside empty files and files of their own."""
    files = {f"{n} #{n}+{n}": os.urandom(n * 37 % 5_000) for n in range(400)} | {"large": os.urandom(1_000_003), "e1": b"", "e2": b""}
    root = str(tmp_path / "t")
    write_packed(spark.createDataFrame([(k, bytearray(v)) for k, v in files.items()], "relpath string, content binary").repartition(3), root)
    files["own#1+1"] = os.urandom(2_500)
    with open(f"{root}/own#1+1", "wb") as out:
        out.write(files["own#1+1"])
    found = range_digests(listing(spark, root), 1_000)
    want = {(name, at // 1_000, at, len(data[at:at + 1_000]), hashlib.sha256(data[at:at + 1_000]).hexdigest())
            for name, data in files.items() for at in range(0, max(len(data), 1), 1_000)}
    assert {(r.relpath, r.range_no, r.start, r.length, r.sha256) for r in found.collect()} == want and found.count() == len(want)
    assert {r.relpath: (r.bytes, r.root) for r in tree_roots(found, 16).collect()} == {k: (len(v), root_of(v, 1_000, 16)) for k, v in files.items()}
    pack = max(os.scandir(f"{root}/_packs"), key=lambda e: e.stat().st_size)
    files = listing(spark, root)
    with open(pack.path, "r+b") as out:
        out.truncate(pack.stat().st_size - 1)
    with pytest.raises(Exception, match="became shorter"):
        range_digests(files, 1_000)


def test_neighbours_in_a_pack_are_read_by_one_task(spark, tmp_path):
    """Else every task reads some of every part of the tree, and what all tasks read grows with their number."""
    write_packed(spark.range(20_000).select(F.col("id").cast("string").alias("relpath"), F.repeat(F.lit("x"), 1_500).cast("binary").alias("content")), str(tmp_path / "t"))
    found = range_digests(listing(spark, str(tmp_path / "t")), 1_000).select("relpath", F.input_file_name().alias("task"))
    assert found.count() == 40_000 and found.select("task").distinct().count() >= 8
    assert found.distinct().count() < 1.1 * 20_000


def test_empty_files_are_many_tasks(spark, tmp_path):
    write_packed(spark.range(1_000).coalesce(1).select(F.col("id").cast("string").alias("relpath"), F.lit(b"").alias("content")), str(tmp_path / "t"))
    found = range_digests(listing(spark, str(tmp_path / "t")), 1_000)
    assert found.count() == 1_000 and found.select(F.input_file_name()).distinct().count() > 4


def test_tasks_follow_the_number_of_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "TASK_RANGES", 50)
    (tmp_path / "large").write_bytes(b"z" * 1_000_000)
    assert range_digests(listing(spark, str(tmp_path)), 1_000).select(F.input_file_name()).distinct().count() > 12
