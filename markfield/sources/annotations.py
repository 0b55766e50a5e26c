"""Point annotation files: scan, decode and derive facts from the name."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markfield.config import Taxonomy
from markfield.functions import geometry as G
from markfield.functions import names as N
from markfield.operators.dedup import content_duplicates, coordinate_duplicates, coordinate_set_key
from markfield.operators.mapping import file_reason, map_to_raster
from markfield.operators.skew import hot_keys, settle
from markfield.sources.files import RASTER_SUFFIXES, listing, read_contents

# Fixed values of the public ImageJ ROI format (big endian).
ROI_MAGIC = b"Iout"
ROI_HEADER = 64
ROI_POINT = 10
ROI_SUBPIXEL_OPTION = 128
ROI_SUBPIXEL_VERSION = 222

DECODED = T.StructType([
    T.StructField("xs", T.ArrayType(T.DoubleType())), T.StructField("ys", T.ArrayType(T.DoubleType())),
    T.StructField("subpixel", T.BooleanType()), T.StructField("problem", T.StringType())])


def _field(data: np.ndarray, at: np.ndarray, kind: str) -> np.ndarray:
    """A big-endian number at every offset of the buffer."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(data[at[:, None] + np.arange(size)]).view(kind).ravel()


def decode_columns(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """All files of one buffer at once: ``problem`` per file ("" for none), ``subpixel``, ``count``, and all xs and ys.

    Coordinates are as stored (whole ones made absolute), one file's after another's; files with a problem have none.
    The first failing rule names the problem.
    """
    n = len(starts)
    problem = np.full(n, "", object)

    def settle_problem(which: np.ndarray, name: str) -> None:
        problem[which[problem[which] == ""]] = name

    settle_problem(np.flatnonzero(lengths == 0), "empty_file")
    settle_problem(np.flatnonzero(lengths < ROI_HEADER), "not_an_imagej_roi")
    known = np.flatnonzero(problem == "")
    head = data[starts[known][:, None] + np.arange(ROI_HEADER)]
    settle_problem(known[(head[:, :4] != np.frombuffer(ROI_MAGIC, np.uint8)).any(axis=1)], "not_an_imagej_roi")
    settle_problem(known[head[:, 6] != ROI_POINT], "not_a_point_roi")

    def number(at: int, kind: str) -> np.ndarray:
        return np.ascontiguousarray(head[:, at:at + np.dtype(kind).itemsize]).view(kind).ravel().astype(np.int64)

    page, second = number(56, ">i4"), number(60, ">i4")
    with_second = np.flatnonzero((second > 0) & (second <= lengths[known] - 16))
    for place in (8, 12):
        page[with_second] = np.maximum(page[with_second], _field(data, starts[known[with_second]] + second[with_second] + place, ">i4"))
    settle_problem(known[page > 1], "roi_refers_to_another_page")
    count, subpixel = np.zeros(n, np.int64), np.zeros(n, bool)
    count[known] = np.where(number(16, ">u2") > 0, number(16, ">u2"), number(18, ">i4"))
    subpixel[known] = (number(50, ">u2") & ROI_SUBPIXEL_OPTION > 0) & (number(4, ">i2") >= ROI_SUBPIXEL_VERSION)
    settle_problem(np.flatnonzero(count <= 0), "invalid_point_coordinates")
    size = np.where(subpixel, 4, 2)
    first = ROI_HEADER + np.where(subpixel, 4 * count, 0)
    settle_problem(np.flatnonzero(first + 2 * count * size > lengths), "decode_error")

    count[problem != ""] = 0
    ends = np.cumsum(count)
    owner = np.repeat(np.arange(n), count)
    inside = np.arange(len(owner)) - (ends - count)[owner]
    axes = []
    for axis, corner in ((0, 10), (1, 8)):
        at = starts[owner] + first[owner] + (axis * count[owner] + inside) * size[owner]
        value, exact = np.empty(len(owner)), subpixel[owner]
        value[exact] = _field(data, at[exact], ">f4")
        base = np.zeros(n)
        base[known] = number(corner, ">i2")
        value[~exact] = _field(data, at[~exact], ">i2") + base[owner[~exact]]
        axes.append(value)
    broken = np.unique(owner[~(np.isfinite(axes[0]) & np.isfinite(axes[1]))])
    settle_problem(broken, "invalid_point_coordinates")
    kept = problem[owner] == ""
    count[broken] = 0
    return problem, subpixel, count, axes[0][kept], axes[1][kept]


@F.arrow_udf(DECODED)
def _decode(contents: pa.Array) -> pa.Array:
    whole = contents.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    values = whole.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    problem, subpixel, count, xs, ys = decode_columns(data, offsets[:-1], np.diff(offsets))
    bad = problem != ""
    places = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
    lists = [pa.ListArray.from_arrays(places, pa.array(axis), mask=pa.array(bad)) for axis in (xs, ys)]
    return pa.StructArray.from_arrays(
        [*lists, pa.array(subpixel, mask=bad), pa.array(problem, pa.string(), mask=~bad)], names=["xs", "ys", "subpixel", "problem"])


def scan_annotations(spark: SparkSession, root: str) -> DataFrame:
    """``relpath, bytes, content`` of every ``.roi`` below ``root`` (archives are not read)."""
    return read_contents(listing(spark, root, (".roi",)).filter(F.col("relpath").endswith(".roi")))


def decode_annotations(files: DataFrame) -> DataFrame:
    """Replace ``content`` by ``sha256, subpixel, points, point_count, decode_problem``.

    Points are at pixel centres: integer-only files are moved by half a pixel.
    """
    decoded = files.withColumn("_d", _decode("content"))
    shifted = F.zip_with("_d.xs", "_d.ys", lambda x, y: F.struct(
        G.to_pixel_centre(x, F.col("_d.subpixel")).alias("x"),
        G.to_pixel_centre(y, F.col("_d.subpixel")).alias("y")))
    return decoded.select(
        *[c for c in files.columns if c != "content"], F.sha2("content", 256).alias("sha256"),
        F.col("_d.subpixel").alias("subpixel"), F.when(F.col("_d.problem").isNull(), shifted).alias("points"),
        F.when(F.col("_d.problem").isNull(), F.size("_d.xs")).alias("point_count"),
        F.col("_d.problem").alias("decode_problem"))


def name_facts(files: DataFrame, taxonomy: Taxonomy | None = None, legacy_double_stem: bool = False) -> DataFrame:
    """Add ``area, stage, label, subtype, fine_label, label_problem, stem`` from ``relpath``."""
    taxonomy = taxonomy or Taxonomy()
    path, own_stem = F.col("relpath"), F.col("stem")
    text = N.stem(own_stem) if legacy_double_stem else own_stem
    staged = files.withColumn("stem", F.trim(N.stem(N.file_name(path))))
    tokens, letters = N.label_tokens(text, taxonomy)
    staged = staged.withColumns({
        "area": N.area_of(path), "stage": F.coalesce(N.stage_of(own_stem), N.stage_of(N.parent_path(path))),
        "_tokens": tokens, "_letters": letters})
    label, subtype = N.label_and_subtype(F.col("_tokens"), F.col("_letters"))
    staged = staged.withColumns({"label": label, "subtype": subtype})
    problem = N.label_problem(F.col("_letters"), F.col("label"), F.col("subtype"), taxonomy)
    return staged.withColumns({
        "fine_label": N.fine_label(F.col("label"), F.col("subtype")), "label_problem": problem,
    }).drop("_tokens", "_letters")


def resolve_files(decoded: DataFrame, rasters: DataFrame, taxonomy: Taxonomy | None = None,
                  legacy_double_stem: bool = False) -> DataFrame:
    """Status and reason of every decoded annotation file.

    ``rasters`` is a listing of image files. A file is a content duplicate of an earlier
    eligible file even when that one cannot be mapped to a raster.
    """
    facts = name_facts(decoded, taxonomy, legacy_double_stem)
    area_problem = F.when(F.col("area").isNull(), "no_area_folder")
    own = facts.withColumn("_own", file_reason(area_problem, F.col("label_problem"), F.col("decode_problem")))
    # Read by every step below; written once so files are decoded once.
    own = settle(own, "annotation_facts")
    unique = content_duplicates(own, F.col("_own").isNull())
    same_bytes = F.when(F.col("duplicate_of").isNotNull(), "duplicate_bytes")
    crowded = hot_keys(own.select(N.image_directory(F.col("relpath")).alias("directory")), ["directory"])
    mapped = map_to_raster(unique, rasters, crowded)
    linked = mapped.withColumn("reason", file_reason(F.col("_own"), same_bytes, F.col("mapping_problem")))
    ok = F.col("reason").isNull()
    hint = N.image_hint(F.col("stem"), F.col("area"), taxonomy)
    linked = linked.withColumns({
        "image": F.when(ok, F.col("image")), "mapping_basis": F.when(ok, F.col("mapping_basis")),
        "image_hint_in_name": F.when(ok, hint)})
    matches = N.hint_matches(F.col("image_hint_in_name"), N.stem(N.file_name(F.col("image"))))
    linked = linked.withColumn("hint_matches_image", matches).withColumn(
        "warnings", N.hint_warnings(F.col("hint_matches_image"))).withColumn(
        "coordinate_key", F.when(ok, coordinate_set_key(F.col("points"))))
    renamed = settle(linked.withColumnRenamed("duplicate_of", "_bytes_of"), "linked_annotations")
    final = coordinate_duplicates(renamed, F.col("reason").isNull())
    again = F.when(F.col("duplicate_of").isNotNull(), "duplicate_coordinates")
    decoded_only = F.coalesce(area_problem, F.col("label_problem")).isNull()
    return final.withColumn("reason", file_reason(F.col("reason"), again)).withColumns({
        "duplicate_of": F.coalesce("_bytes_of", "duplicate_of"),
        "status": F.when(F.col("reason").isNull(), "mapped").otherwise("excluded"),
        # Files rejected by name are never decoded in the published record.
        "points": F.when(decoded_only, F.col("points")),
        "point_count": F.when(decoded_only, F.col("point_count")),
        "subpixel": F.when(decoded_only, F.col("subpixel")),
    }).drop("_own", "_bytes_of", "label_problem", "decode_problem", "mapping_problem", "coordinate_key", "stem")


def discover(spark: SparkSession, root: str, taxonomy: Taxonomy | None = None,
             legacy_double_stem: bool = False) -> DataFrame:
    """Every annotation file below ``root`` with label, image, status, reason and points."""
    decoded = decode_annotations(scan_annotations(spark, root))
    return resolve_files(decoded, listing(spark, root, RASTER_SUFFIXES), taxonomy, legacy_double_stem)
