"""Raster and file readers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from markfield.config import CONTROL_SHIFTS
from markfield.operators.grids import probe_windows, window_spread
from markfield.operators.skew import work_partitions
from markfield.sources import rasters as S
from markfield.sources.files import changed_files, file_digests, listing, read_json_document, read_table_csv
from tests.support import read_rows, write_jpeg, write_tiff


@pytest.fixture(scope="module")
def pixels():
    return np.random.default_rng(11).integers(0, 255, (230, 190, 3), dtype=np.uint8)


@pytest.fixture(scope="module")
def folder(pixels, tmp_path_factory):
    root = tmp_path_factory.mktemp("rasters +1%")
    for rows in (None, 1, 7, 64):
        write_tiff(root / "a b" / f"strips_{rows}.tif", pixels, rows_per_strip=rows)
    return root


@pytest.fixture(scope="module")
def heads(spark, folder):
    return S.tiff_headers(listing(spark, str(folder), (".tif",)))


@pytest.mark.parametrize("chunk", [1000, 16 << 20])
def test_strip_rows(spark, heads, pixels, chunk, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    rows = S.strip_rows(heads)
    for name in ("strips_None", "strips_1", "strips_7", "strips_64"):
        assert np.array_equal(read_rows(rows.filter(F.col("image").contains(name + ".")), 190), pixels)


def test_image_source_gives_the_same_rows(spark, folder, heads, pixels):
    paths = [r.path for r in heads.select("path").collect()]
    rows = S.image_rows(spark, paths, str(folder))
    assert rows.select("image").distinct().count() == 4
    assert rows.select("image").distinct().exceptAll(heads.select("relpath")).count() == 0
    assert np.array_equal(read_rows(rows.filter(F.col("image").contains("strips_7.")), 190), pixels)


@pytest.mark.parametrize("chunk", [1, 16 << 20])
def test_windows_at_offsets(spark, heads, pixels, chunk, monkeypatch):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    rng = np.random.default_rng(3)
    boxes = [(n, int(x), int(y)) for n, (x, y) in enumerate(zip(rng.integers(0, 190 - 32, 60), rng.integers(0, 230 - 32, 60)))]
    boxes += [(100, 158, 198), (101, 0, 0)]
    table = spark.createDataFrame(boxes, "k int, left int, top int").crossJoin(heads.select("relpath", "path")).select(
        F.concat_ws("@", "k", "relpath").alias("key"), "path", "left", "top")
    got = {r.key: bytes(r.pixels) for r in S.read_patches(table, ["key"], 32).collect()}
    assert len(got) == 4 * len(boxes)
    for key, data in got.items():
        _, x, y = next(b for b in boxes if b[0] == int(key.split("@")[0]))
        assert data == pixels[y:y + 32, x:x + 32].tobytes()


def test_spreads_agree_with_the_join(spark, heads, pixels):
    one = heads.filter(F.col("relpath").contains("strips_64"))
    rng = np.random.default_rng(8)
    points = spark.createDataFrame([(n, float(x) + 0.5, float(y) + 0.5) for n, (x, y) in enumerate(rng.integers(50, 135, (20, 2)))],
                                   "point_no int, x double, y double")
    points = points.crossJoin(one.select(F.col("relpath").alias("image"), "path"))
    direct = S.read_spreads(probe_windows(points, 7, CONTROL_SHIFTS), ["point_no", "shift"], 15)
    joined = window_spread(points.drop("path"), S.strip_rows(one), ["point_no"], 7, CONTROL_SHIFTS)
    assert direct.count() == 180 and direct.exceptAll(joined.select(direct.columns)).count() == 0


def test_window_outside_is_an_error(spark, heads):
    boxes = heads.limit(1).select(F.lit("k").alias("key"), "path", F.lit(170).alias("left"), F.lit(0).alias("top"))
    with pytest.raises(Exception, match="window outside the raster"):
        S.read_patches(boxes, ["key"], 32).collect()


def test_unfit_tiffs(spark, tmp_path, pixels):
    write_tiff(tmp_path / "x.tif", pixels)
    data = bytearray((tmp_path / "x.tif").read_bytes())
    (tmp_path / "text.tif").write_bytes(b"plain text, long enough")
    data[-4:] = (8).to_bytes(4, "little")
    (tmp_path / "pages.tif").write_bytes(bytes(data))
    got = {r.relpath: r.problem for r in S.tiff_headers(listing(spark, str(tmp_path), (".tif",))).collect()}
    assert got == {"x.tif": None, "text.tif": "unreadable TIFF", "pages.tif": "expected single-page TIFF"}


def test_jpeg_orientation_is_recorded(spark, tmp_path, pixels):
    plain = tmp_path / "plain.jpg"
    write_jpeg(spark, plain, pixels)
    exif = b"Exif\0\0II*\0\x08\0\0\0\x01\0\x12\x01\x03\0\x01\0\0\0\x06\0\0\0\0\0\0\0"
    data = plain.read_bytes()
    (tmp_path / "turned.jpg").write_bytes(data[:2] + b"\xff\xe1" + (len(exif) + 2).to_bytes(2, "big") + exif + data[2:])
    got = {r.relpath: r for r in S.jpeg_headers(listing(spark, str(tmp_path), (".jpg",))).collect()}
    assert got["turned.jpg"].exif_orientation == 6 and got["plain.jpg"].exif_orientation is None
    assert (got["turned.jpg"].width, got["turned.jpg"].height) == (190, 230)


def test_listing_keeps_empty_and_hidden_files(spark, tmp_path):
    for name in ("a/_x.roi", "a/.y.roi", "a/b/c/empty.roi", "top.ROI"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else b"12")
    found = listing(spark, str(tmp_path), (".roi",))
    assert {r.relpath: r.bytes for r in found.collect()} == {"a/_x.roi": 2, "a/.y.roi": 2, "a/b/c/empty.roi": 0, "top.ROI": 2}
    assert {r.relpath for r in listing(spark, str(tmp_path), hidden=False).collect()} == {"a/b/c/empty.roi", "top.ROI"}
    import hashlib
    assert {r.sha256 for r in file_digests(found).collect()} == {hashlib.sha256(b).hexdigest() for b in (b"", b"12")}
    (tmp_path / "top.ROI").write_bytes(b"123")
    assert [r.relpath for r in changed_files(found, listing(spark, str(tmp_path))).collect()] == ["top.ROI"]


def test_csv_and_json(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿a,b\n1,\"x \"\"y\"\"\nz\"\n", encoding="utf-8")
    row = read_table_csv(spark, str(tmp_path / "t.csv")).head()
    assert (row.a, row.b) == ("1", 'x "y"\nz')
    (tmp_path / "d.json").write_text('{"schema": "s",\n "n": 2}')
    assert read_json_document(spark, str(tmp_path / "d.json")).head().n == 2


def test_tasks_grow_with_the_bytes(spark):
    files = spark.createDataFrame([("a", 3_000), ("b", 7_000)], "relpath string, bytes long")
    assert work_partitions(spark, files, task_bytes=100) == 100
    assert work_partitions(spark, files, task_bytes=20_000) == work_partitions(spark)


def test_spreads_from_summed_areas(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(9)
    pixels = rng.integers(0, 256, (150, 210, 3)).astype(np.uint8)
    path = tmp_path / "plate.tif"
    write_tiff(path, pixels, rows_per_strip=13)
    spots = np.concatenate([rng.integers(0, 120, (400, 2)), np.tile([[7, 9]], (20, 1)), [[0, 0], [0, 135], [195, 0], [195, 135]]])
    boxes = spark.createDataFrame([(n, str(path), int(x), int(y)) for n, (x, y) in enumerate(spots)], "n int, path string, left int, top int")

    def brute(x, y, side):
        grey = pixels[y:y + side, x:x + side].sum(axis=2, dtype=np.int64)
        return grey.size * int((grey * grey).sum()) - int(grey.sum()) ** 2

    for side in (1, 15):
        found = {r.n: r.spread for r in S.read_spreads(boxes, ["n"], side).collect()}
        assert found == {n: brute(int(x), int(y), side) for n, (x, y) in enumerate(spots)}
    lefts, tops = spots[np.argsort(spots[:, 1], kind="stable")].T
    for cells in (1, 900, 10**6):
        monkeypatch.setattr(S, "TABLE_CELLS", cells)
        clusters = list(S._clusters(lefts, tops, 15, max(15, cells // 210)))
        assert sorted(np.concatenate(clusters).tolist()) == list(range(len(lefts)))
    with pytest.raises(Exception, match="window outside the raster"):
        S.read_spreads(boxes.limit(1).selectExpr("n", "path", "left + 205 AS left", "top"), ["n"], 15).collect()
