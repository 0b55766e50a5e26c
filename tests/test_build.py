"""The whole job on a scene of discs; what is expected follows from the scene's own points."""

import json
import shutil
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from markfield.config import Settings, Taxonomy
from markfield.operators.report import unknown_labels
from markfield.plans.build import build
from markfield.plans.publish import POINT_COLUMNS, SAMPLE_COLUMNS
from markfield.plans.validate import validate, validation_report
from markfield.sources.files import listing, read_string_map, read_table_csv
from markfield.sources.rasters import jpeg_headers, strip_rows, tiff_headers
from tests.support import HIGH, SCENE, SCENE_OVERRIDES, SCENE_SPLITS, WIDE, read_rows, scene, write_points, write_tiff


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    """Source folder, discs, output folder and manifest of one build."""
    folder = tmp_path_factory.mktemp("job")
    discs = scene(spark, folder / "in put")
    manifest = build(spark, str(folder / "in put"), str(folder / "set"), SCENE_SPLITS, SCENE_OVERRIDES, settings=SCENE, revision="r1")
    return folder / "in put", discs, str(folder / "set"), manifest


def files_of(spark, out):
    return {row.relpath.rsplit("/", 1)[1]: row for row in read_table_csv(spark, f"{out}/roi_files.csv").collect()}


def test_every_file_has_its_reason(spark, job):
    files = files_of(spark, job[2])
    assert {name: row.reason for name, row in files.items() if row.status != "used"} == {
        "after_2_BPD again.roi": "duplicate_bytes", "before_3_other.roi": "unknown_label", "before_3_TED(a).roi": "empty_file",
        "before_3_TED(b).roi": "decode_error", "before_BPD.roi": "x100_magnified_image_different_scale",
        "BPD.roi": "ambiguous_tiff_no_stage_in_name"}
    assert files["after_2_BPD again.roi"].duplicate_of.endswith("after step_2/after_2_BPD.roi")
    listed = {row.relpath.rsplit("/", 1)[1]: row.reason for row in spark.read.json(f"{job[2]}/excluded_roi_files.json").collect()}
    assert listed == {name: row.reason for name, row in files.items() if row.status != "used"}


def test_grids_follow_the_discs(spark, job):
    files = files_of(spark, job[2])
    grid = {name: (row.coordinate_transform, row.transform_basis) for name, row in files.items() if row.status == "used"}
    assert grid["after_2_BPD.roi"] == ("identity", "contrast_probe_tiff_grid")
    assert grid["after_2_TED(f).roi"] == ("vflip", "contrast_probe_raw_jpeg_grid")
    assert grid["after_2_ted (f) rest.roi"] == ("vflip", "inherited_from_same_image_same_class_files")
    assert grid["before_3_BPD.roi"] == ("identity", "tiff_grid_only_candidate")


def test_rasters(spark, job):
    records = {row.relpath: row for row in spark.read.json(f"{job[2]}/images.json").collect()}
    four, seven, eight = (records[name] for name in (
        "4 Area/after step_2/after_2.tiff", "7 Area/before step_1/before_1.tif", "8 Area/before step_3/before_3.tif"))
    assert (four.pixel_check, four.split) == ("tiff_bit_identical_to_jpeg_vflip", "test")
    assert (seven.pixel_source, seven.pixel_check) == ("jpeg_hflip", "tiff_damaged_rebuilt_from_jpeg")
    assert seven.tiff_damaged_row_fraction == pytest.approx((HIGH - 170) / HIGH, abs=1e-6)
    assert seven.tiff_differing_pixels == seven.tiff_differing_pixels_pure_white > 0.9 * (HIGH - 170) * WIDE
    assert (eight.pixel_check, eight.split, eight.jpeg_to_tiff) == ("no_jpeg_pair_unverified", "unassigned", "none")
    owned = Counter(row.image for row in spark.read.json(f"{job[2]}/image_files.json").collect())
    assert owned == {four.relpath: 4, seven.relpath: 1, eight.relpath: 1}


def test_near_share_covers_every_differing_pixel(spark, job):
    source, discs, out, _ = job
    record = spark.read.json(f"{out}/images.json").filter("pixel_source <> 'tiff'").head()
    y, x = np.mgrid[170:HIGH, :WIDE] + 0.5
    close = np.zeros(y.shape, bool)
    for px, py in discs["7"][0]:
        close |= np.hypot(x - px, y - py) <= 2
    assert record.tiff_differing_pixels_within_2px_of_roi_point == pytest.approx(close.mean(), abs=2e-3)


def test_points_and_counts(spark, job):
    _, discs, out, manifest = job
    points = read_table_csv(spark, f"{out}/points.csv")
    assert points.columns == POINT_COLUMNS
    given = len(discs["4"][0]) + len(discs["4"][1]) + len(discs["7"][0]) + len(discs["8"][0])
    rows = points.collect()
    reasons = Counter(row.reason or "" for row in rows)
    assert manifest["counts"]["unique_points"] == len(rows)
    assert reasons.pop("") == manifest["counts"]["patches"]
    assert reasons == manifest["counts"]["excluded_points_by_reason"]
    extra = [row for row in rows if row.fine_label == "TSD_b"]
    assert len(extra) == 2 and len(rows) == given + 2
    assert reasons == {"patch_crosses_image_boundary": 1, "other_label_within_center_16px": 2}
    lineage = spark.read.parquet(f"{out}/point_refs")
    assert lineage.count() == len(rows) and lineage.select("point_id").distinct().count() == len(rows)


def test_patches_hold_the_discs(spark, job):
    source, discs, out, _ = job
    samples = read_table_csv(spark, f"{out}/samples.csv")
    assert samples.columns == SAMPLE_COLUMNS
    patches = {row.patch_id: np.frombuffer(bytes(row.pixels), np.uint8).reshape(64, 64, 3)
               for row in spark.read.parquet(f"{out}/patches_64").collect()}
    rows = samples.collect()
    assert len(rows) == len(patches) and [row.path for row in rows] == sorted(row.path for row in rows)
    heads = tiff_headers(listing(spark, str(source), (".tif", ".tiff")))
    eight = read_rows(strip_rows(heads.filter(F.col("relpath").startswith("8 "))), WIDE)
    for row in rows:
        patch, left, top = patches[row.patch_id].astype(int), int(row.left), int(row.top)
        middle = patch[30:34, 30:34, 0].mean()
        assert (middle > 160) if row.label in ("BPD", "TSD") else (middle < 70), row.path
        if row.area == "8":
            assert np.array_equal(patch, eight[top:top + 64, left:left + 64])
    assert {(row.area, row.split) for row in rows} == {("4", "test"), ("7", "train"), ("8", "unassigned")}


def test_manifest_and_previews(spark, job):
    _, _, out, manifest = job
    stored = json.loads(spark.read.option("wholetext", True).text(f"{out}/manifest.json").head()[0])
    assert stored == json.loads(json.dumps(manifest))
    assert manifest["started_at"] < manifest["created_at"] and manifest["code_revision"] == "r1"
    assert manifest["split_map"] == SCENE_SPLITS and "rare_fine_labels_under_40" in manifest
    assert manifest["notes"] == []
    for name in ("coordinate_space", "transforms", "settings"):
        assert manifest[name]
    shown = spark.read.parquet(f"{out}/preview_samples").groupBy("fine_label").count()
    assert shown.filter(F.col("count") > SCENE.preview_per_label).count() == 0
    assert spark.read.parquet(f"{out}/preview_means").groupBy("fine_label").count().filter(f"count <> {64 * 64 * 3}").count() == 0


def test_finished_set_validates_until_a_byte_changes(spark, job, tmp_path):
    out = job[2]
    assert validate(spark, out, unexpected_files=True)["patches"] == job[3]["counts"]["patches"]
    assert [row.passed for row in validation_report(spark, out).collect()].count(False) == 0
    shutil.copytree(out, tmp_path / "hurt")
    for note in (tmp_path / "hurt").rglob("*.crc"):
        note.unlink()
    part = next((tmp_path / "hurt" / "point_refs").glob("*.parquet"))
    data = bytearray(part.read_bytes())
    data[len(data) // 2] ^= 1
    part.write_bytes(bytes(data))
    with pytest.raises(ValueError, match="point_refs"):
        validate(spark, str(tmp_path / "hurt"))
    shutil.rmtree(tmp_path / "hurt" / "output_hashes")
    with pytest.raises(ValueError, match="do not use"):
        validate(spark, str(tmp_path / "hurt"))


@pytest.mark.parametrize(("place", "splits", "overrides", "message"), [
    ("set", {}, {}, "never written over"), ("in put/new", {}, {}, "inside the source"), ("new", {"4": "dev"}, {}, "split name"),
    ("new", {}, {"x.roi": "rot180"}, "override")])
def test_refused_arguments(spark, job, place, splits, overrides, message):
    source = job[0]
    with pytest.raises(ValueError, match=message):
        build(spark, str(source), str(source.parent / place), splits, overrides)
    with pytest.raises(ValueError, match="no source folder"):
        build(spark, str(source / "gone"), str(source.parent / "new"), {})


@pytest.mark.parametrize("tag", [(258, 9), (284, 2)])
def test_unfit_raster_stops_the_build(spark, tmp_path, tag):
    """Other sample depths and planes stored apart are refused; the folder is marked."""
    image = tmp_path / "in" / "3 Area" / "before" / "before.tif"
    write_tiff(image, np.zeros((90, 80, 3), np.uint8))
    data = bytearray(image.read_bytes())
    number, value = tag
    at = data.index(number.to_bytes(2, "little") + b"\x03\x00", 8 + 90 * 80 * 3)
    place = int.from_bytes(data[at + 8:at + 12], "little") if number == 258 else at + 8
    data[place] = value
    image.write_bytes(bytes(data))
    write_points(image.parent / "before_BPD.roi", [[40.5, 40.5]])
    with pytest.raises(ValueError, match="RGB"):
        build(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert (tmp_path / "out" / "BUILD_FAILED.json").exists()


def test_nothing_to_use(spark, tmp_path):
    write_points(tmp_path / "in" / "3 Area" / "before" / "before_other.roi", [[1.5, 1.5]])
    with pytest.raises(ValueError, match="no annotation file"):
        build(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_set_without_patches_is_a_set(spark, tmp_path):
    folder = tmp_path / "in" / "6 Area" / "after"
    write_tiff(folder / "after.tif", np.full((70, 75, 3), 9, np.uint8))
    write_points(folder / "after_TSD(c).roi", [[30.5, 30.5], [75.5, 10.5]])
    manifest = build(spark, str(tmp_path / "in"), str(tmp_path / "out"), {}, settings=Settings(patch_size=70))
    assert manifest["counts"]["patches"] == 0 and manifest["counts"]["unique_points"] == 2
    assert sum(manifest["counts"]["excluded_points_by_reason"].values()) == 2
    assert validate(spark, str(tmp_path / "out"))["patches"] == 0


def test_override_wins(spark, job, tmp_path):
    name = "4 Area/after step_2/after_2_TED(f).roi"
    build(spark, str(job[0]), str(tmp_path / "out"), SCENE_SPLITS, {name: "hflip"}, settings=SCENE)
    files = files_of(spark, str(tmp_path / "out"))
    assert (files["after_2_TED(f).roi"].coordinate_transform, files["after_2_TED(f).roi"].transform_basis) == ("hflip", "manual_override")


def test_headers_of_the_scene(spark, job):
    heads = {Path(row.relpath).name: row for row in tiff_headers(listing(spark, str(job[0]), (".tif", ".tiff"))).collect()}
    assert {(row.width, row.height, row.compression, row.strips) for row in heads.values()} == {(WIDE, HIGH, "NONE", True)}
    assert heads["after_2.tiff"].rows_per_strip == 37
    twins = jpeg_headers(listing(spark, str(job[0]), (".jpg", ".jpeg"))).collect()
    assert {(row.width, row.height, row.mode, row.exif_orientation) for row in twins} == {(WIDE, HIGH, "RGB", None)}


def test_string_map_with_a_mark_in_front(spark, tmp_path):
    (tmp_path / "m.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"8": "val", "10": "test"}).encode())
    assert {tuple(row) for row in read_string_map(spark, str(tmp_path / "m.json"), "k", "v").collect()} == {("8", "val"), ("10", "test")}


def test_labels_outside_the_taxonomy(spark):
    rows = spark.createDataFrame([("BPD",), ("TED_q",)], "fine_label string")
    assert [row.fine_label for row in unknown_labels(rows, Taxonomy()).collect()] == ["TED_q"]


def test_job_leaves_no_tables(spark, job):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not [p for p in folder.glob("markfield-*/*") if p.name.split("-")[0] in ("points", "samples", "packed_rows", "tiff_headers")]
