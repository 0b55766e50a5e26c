"""Linking annotation files to rasters and lookups by image, area and file."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.functions import names as N
from markfield.operators.skew import lookup_join

LITERAL_LIMIT = 500
TIFF_SUFFIXES = (".tif", ".tiff")
JPEG_SUFFIXES = (".jpg", ".jpeg")


def directory_summary(listing: DataFrame) -> DataFrame:
    """What each folder holds, from a listing of ``relpath``: counts and sole candidates."""
    name = N.file_name(F.col("relpath"))
    kind = N.suffix(name)
    stage = N.stage_of(N.stem(name))
    seen = listing.select("relpath", N.parent_path(F.col("relpath")).alias("directory"),
                          kind.isin(*TIFF_SUFFIXES).alias("tiff"), kind.isin(*JPEG_SUFFIXES).alias("jpeg"),
                          stage.alias("stage")).filter(F.col("tiff") | F.col("jpeg"))
    tiff = F.col("tiff")

    def only(condition: Column, name: str) -> list[Column]:
        return [F.count_if(condition).alias(f"{name}_tiffs"),
                F.min(F.when(condition, F.col("relpath"))).alias(f"{name}_tiff")]

    return seen.groupBy("directory").agg(
        *only(tiff, "all"), *only(tiff & (F.col("stage") == "before"), "before"),
        *only(tiff & (F.col("stage") == "after"), "after"), F.bool_or("jpeg").alias("has_jpeg"))


def map_to_raster(files: DataFrame, listing: DataFrame, crowded: DataFrame | None = None) -> DataFrame:
    """Add ``image, mapping_basis, mapping_problem`` to files with ``relpath, stage``.

    ``crowded`` may name the folders with very many files when the caller knows them.
    """
    directory = N.image_directory(F.col("relpath"))
    located = files.withColumn("directory", directory)
    # Named once a folder, not once a file.
    folders = directory_summary(listing).withColumn("_own_stage", N.stage_of(N.stem(N.file_name(F.col("all_tiff")))))
    joined = lookup_join(located, folders, ["directory"], ["relpath"], hot=crowded)
    total = F.coalesce("all_tiffs", F.lit(0))
    same_stage = F.when(F.col("stage") == "before", F.col("before_tiffs")).otherwise(F.col("after_tiffs"))
    stage_tiff = F.when(F.col("stage") == "before", F.col("before_tiff")).otherwise(F.col("after_tiff"))
    own_stage = F.col("_own_stage")
    problem = (
        F.when(N.is_magnified(F.col("directory")), "x100_magnified_image_different_scale")
        .when((total == 0) & F.coalesce("has_jpeg", F.lit(False)), "no_tiff_in_directory_jpg_only")
        .when(total == 0, "no_tiff_in_directory")
        .when((total > 1) & F.col("stage").isNull(), "ambiguous_tiff_no_stage_in_name")
        .when((total > 1) & (same_stage != 1), "ambiguous_tiff_for_stage")
        .when((total == 1) & F.col("stage").isNotNull() & own_stage.isNotNull() & (F.col("stage") != own_stage),
              "roi_stage_conflicts_with_tiff")
    )
    keep = [F.col(c) for c in files.columns]
    return joined.select(*keep, problem.alias("mapping_problem"),
                         F.when(problem.isNull(), F.when(total == 1, F.col("all_tiff")).otherwise(stage_tiff))
                         .alias("image"),
                         F.when(problem.isNull(), F.when(total == 1, "same_directory_unique_tiff")
                                .otherwise("same_directory_tiff_matching_stage")).alias("mapping_basis"))


def twin_path(tiff: Column) -> Column:
    """Path of the same-stem ``.jpg`` (this exact suffix)."""
    return F.concat(F.regexp_replace(tiff, r"\.[^./]*$", ""), F.lit(".jpg"))


def attach_twin(images: DataFrame, listing: DataFrame) -> DataFrame:
    """Add ``twin``: the path of the JPEG beside the raster, null when there is none."""
    jpegs = listing.filter(F.col("relpath").endswith(".jpg")).select(F.col("relpath").alias("twin"))
    wanted = images.withColumn("_twin", twin_path(F.col("image")))
    return wanted.join(jpegs, F.col("_twin") == F.col("twin"), "left").drop("_twin")


def assign_split(rows: DataFrame, splits: DataFrame, spread_by: str) -> DataFrame:
    """Left lookup ``area -> split``; areas outside the map are ``unassigned``."""
    joined = lookup_join(rows, splits.select("area", F.col("split").alias("_split")), ["area"], [spread_by])
    return joined.withColumn("split", F.coalesce("_split", F.lit("unassigned"))).drop("_split")


def literal_lookup(key: Column, values: Mapping[str, str]) -> Column:
    """Value of a caller-supplied mapping; it is already on the driver, so no join is needed."""
    if not values:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*[F.lit(part) for item in sorted(values.items()) for part in item]), key)


def domain_violations(rows: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Distinct values outside the allowed names."""
    return rows.filter(~F.col(column).isin(*allowed) | F.col(column).isNull()).select(column).distinct()


def attach_value(rows: DataFrame, key: str, values: Mapping[str, str], name: str, spread_by: str) -> DataFrame:
    """Add the mapped value of ``key``; long mappings become a table instead of a literal."""
    if len(values) <= LITERAL_LIMIT:
        return rows.withColumn(name, literal_lookup(F.col(key), values))
    table = rows.sparkSession.createDataFrame(sorted(values.items()), f"{key} string, {name} string")
    return lookup_join(rows, table, [key], [spread_by])


def file_reason(*reasons: Column) -> Column:
    """First reason that applies, in the given order."""
    return F.coalesce(*reasons)
