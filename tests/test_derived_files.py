"""Derived raster files, and neighbour counts by squares of cells."""

import itertools
import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from markfield.operators.neighbors import COUNTS, box_neighbors
from markfield.plans import standins as S
from markfield.sources.files import copy_tree, listing, read_contents
from markfield.sources.packs import write_packed
from markfield.sources.rasters import strip_rows, tiff_headers


def test_rasters_are_made_without_a_shuffle_of_their_rows(spark, tmp_path):
    texts = [("äb\n" * 700 if n % 5 else "word ") * (n % 3 + 1) + "x" * n for n in range(40)] + [""]
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "source": ["src1"] * len(texts), "text": texts}), tmp_path / "documents.parquet")
    files = S.tiff_files(spark, str(tmp_path))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan and "hashpartitioning" not in plan
    write_packed(files, str(tmp_path / "tree"))
    heads = tiff_headers(listing(spark, str(tmp_path / "tree"), (".tif",)))
    assert {(r.problem, r.strips) for r in heads.collect()} == {(None, True)} and heads.count() == len(texts)
    stored = {(r.image.removesuffix(".tif"), r.row_no): (r.height, bytes(r.px)) for r in strip_rows(heads).collect()}
    rows = S.tiff_rows(S.document_rows(spark, str(tmp_path)).filter("height > 0")).collect()
    assert stored == {(r.image, r.row_no): (r.height, bytes(r.px)) for r in rows}


def test_a_point_goes_to_four_squares_of_cells(spark):
    draw = random.Random(5)
    points = [(f"i{n % 3}", f"p{n}", "ab"[draw.randrange(2)], draw.randrange(-60, 60) / 2, draw.randrange(-60, 60) / 2) for n in range(400)]
    rows = spark.createDataFrame(points, "image string, point_id string, fine_label string, x double, y double")
    counted = box_neighbors(rows, 8, 4)
    squares = [line for line in counted._jdf.queryExecution().optimizedPlan().toString().splitlines() if "sequence(" in line and "Generate" in line]
    assert len(squares) == 2  # once along x, once along y, each of two squares
    expected = {}
    for one in points:
        expected[one[0], one[1]] = [0, 0, 0]
    for one, two in itertools.permutations(points, 2):
        dx, dy = abs(one[3] - two[3]), abs(one[4] - two[4])
        if one[0] == two[0] and dx < 4 and dy < 4:
            told = expected[one[0], one[1]]
            told[0 if one[2] == two[2] else 1] += 1
            told[2] += one[2] != two[2] and dx < 2 and dy < 2
    assert {(r.image, r.point_id): [r[name] for name in COUNTS] for r in counted.select("image", "point_id", *map(F.col, COUNTS)).collect()} == expected


def test_a_tree_is_copied_by_tasks(spark, tmp_path):
    files = {"a/_x.csv": b"1\n" * 9_000_000, "a/b/.y": b"", "z z#%.bin": bytes(range(256))}
    for relpath, content in files.items():
        (tmp_path / "from" / relpath).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "from" / relpath).write_bytes(content)
    assert copy_tree(spark, str(tmp_path / "from"), str(tmp_path / "to")) == 3
    assert {r.relpath: bytes(r.content) for r in read_contents(listing(spark, str(tmp_path / "to"))).collect()} == files
