"""Registered queries on tables in which every fifth text is empty: rasters without rows."""

import os
import shutil
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from markfield.operators.agreement import difference_report, row_agreement
from markfield.plans import oracle

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle.statements()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    root = tmp_path_factory.mktemp("empty_texts")
    for name in ("events", "documents"):
        shutil.copyfile(f"{DATA}/{name}.parquet", root / f"whole_{name}.parquet")
    duckdb.execute(f"COPY (SELECT * FROM '{root}/whole_events.parquet') TO '{root}/events.parquet'")
    duckdb.execute(f"""COPY (SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN '' ELSE text END AS text, * EXCLUDE (doc_id, text)
                       FROM '{root}/whole_documents.parquet') TO '{root}/documents.parquet'""")
    return str(root)


@pytest.fixture(scope="module")
def engine(tables):
    """The row of a point on a raster without rows is a remainder by zero, which is null here."""
    connection = duckdb.connect()
    connection.execute("SET error_on_division_by_zero = false")
    for name in ("events", "documents"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def found(spark, engine, tables, name):
    """Rows of the query and of its SQL, counted."""
    result = engine.execute(SQL[name])
    columns = [part[0] for part in result.description]
    want = Counter(map(repr, result.fetchall()))
    return Counter(repr(tuple(row)) for row in entry_points.queries()[name](spark, tables).select(*columns).collect()), want


def test_built_counts(spark, engine, tables):
    """Every point is counted; those of rasters without rows are outside."""
    got, want = found(spark, engine, tables, "built_counts")
    points = engine.execute(f'SELECT split, fine_label, status, reason, y IS NULL AS lost FROM ({SQL["built_points"]})').fetchall()
    kept = [(split, label) for split, label, status, _, lost in points if status == "included" and not lost]
    told = Counter(kept) + Counter(("by_fine_label", label) for _, label in kept)
    told += Counter(("excluded_points_by_reason", "point_outside_image" if lost else reason) for *_, status, reason, lost in points
                    if lost or status == "excluded")
    told["whole", "patches"] = len(kept)
    same = ("provider_points_in_used_roi_files", "unique_points", "duplicate_point_refs", "images")
    assert set(got) == {repr((*key, n)) for key, n in told.items()} | {row for row in want if any(f"'{name}'" in row for name in same)}
    assert told["excluded_points_by_reason", "point_outside_image"] > 0


def test_built_points(spark, engine, tables):
    """Points of rasters without rows are published as outside; the others as in the SQL."""
    order = ["image", "split", "fine_label", "x"]
    want = engine.execute(f'SELECT {", ".join(order)}, y, status, reason FROM ({SQL["built_points"]})').fetchall()
    lost = [row[:4] for row in want if row[4] is None]
    got = [tuple(row) for row in entry_points.queries()["built_points"](spark, tables).select(*order, "y", "status", "reason").collect()]
    assert lost and Counter(got) == Counter([row for row in want if row[4] is not None] + [(*row, 0.5, "excluded", "point_outside_image") for row in lost])


def test_images_without_rows_have_no_share(spark):
    rows = spark.createDataFrame([("a", 0, b"abc", 1)], "image string, row_no int, px binary, height int")
    sizes = spark.createDataFrame([("a", 1, 1), ("b", 1, 0), ("c", 1, 0), ("d", 1, 2)], "image string, width int, height int")
    others = spark.createDataFrame([("a", 1, 1), ("b", 1, 0), ("c", 1, 2), ("d", 1, 0)], "image string, width int, height int")
    shares = row_agreement(rows.drop("height"), rows, sizes, others)
    assert {(r.image, r.transform, r.agreement) for r in shares.collect()} == {("a", name, 1.0) for name in ("identity", "hflip", "vflip", "rot180")}


def test_images_without_pixels_have_no_fraction(spark):
    rows = spark.createDataFrame([("a", 2, 1)], "image string, differing bigint, white bigint")
    sizes = spark.createDataFrame([("a", 2, 2), ("b", 2, 0), ("c", 2, None)], "image string, width int, height int")
    assert {(r.image, str(r.tiff_differing_pixel_fraction)) for r in difference_report(rows, sizes).collect()} == {("a", "0.5"), ("b", "nan"), ("c", "None")}


@pytest.mark.parametrize("name", [
    "validated_datasets",
    "best_transform",
    "built_patches",
    "near_point_fraction",
    "nearest_point",
    "nearest_point_any",
    "pixel_source",
    "rebuilt_rows",
    "row_agreement",
    "stored_patches",
    "stored_spreads",
    "difference_positions",
    "difference_positions_all",
    "difference_report",
    "correlation",
    "flip_rows",
    "crop_patches",
    "window_spread",
    "contrast_by_file",
])
def test_query(spark, engine, tables, name):
    got, want = found(spark, engine, tables, name)
    assert got == want and want
