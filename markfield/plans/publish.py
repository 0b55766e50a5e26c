"""Write a finished dataset: tables, patches, counts, manifest and seal.

The manifest is one row and holds only bounded facts. Lists that grow with the data
(excluded files, checksums, lineage) are tables beside it. The seal is written last;
a folder without it, or with a failure marker, is not a dataset.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from markfield.config import SCHEMA_NAME, SCHEMA_VERSION, TRANSFORMS, Settings, Taxonomy
from markfield.operators import report as R
from markfield.operators.dedup import point_lineage
from markfield.operators.findings import digest_text, row_digest
from markfield.sources.files import file_digests, listing
from markfield.sources.ranges import RANGE_BYTES, range_digests

ROWS_PER_FILE = 4096
PATCH_SCHEMA = "patch_id string, sha256 string, pixels binary, split string, fine_label string"

# Fixed column order of the published tables.
POINT_COLUMNS = [
    "point_id", "image_id", "image", "area", "stage", "split", "label", "subtype", "fine_label", "x", "y", "roi_x",
    "roi_y", "coordinate_transform", "center_x", "center_y", "left", "top", "status", "reason",
    "neighbors_same_label_in_patch", "neighbors_other_label_in_patch", "neighbors_other_label_in_center"]
SAMPLE_COLUMNS = [
    "patch_id", "path", "sha256", "point_id", "image_id", "image", "area", "wafer", "stage", "split", "label",
    "subtype", "fine_label", "x", "y", "roi_x", "roi_y", "coordinate_transform", "pixel_source", "center_x",
    "center_y", "left", "top", "size", "dtype", "channels", "neighbors_same_label_in_patch",
    "neighbors_other_label_in_patch", "neighbors_other_label_in_center", "roi_files", "labels_source",
    "expert_verified", "review_status"]
FILE_COLUMNS = [
    "relpath", "sha256", "bytes", "area", "stage", "label", "subtype", "fine_label", "status", "reason",
    "duplicate_of", "point_count", "subpixel", "image", "mapping_basis", "image_hint_in_name", "hint_matches_image",
    "coordinate_transform", "transform_basis", "contrast_probe", "warnings"]


# Fixed values of the published contract.
CONTRACT = {
    "task": "center_point_patch_classification_class_and_subtype", "zip_archives_read": False,
    "labels_source": "provider", "label_basis": "ImageJ_point_ROI_filename", "expert_verified": False, "research_only": True,
}
COORDINATE_SPACE = "tiff_pixel_grid_continuous_pixel_corner_origin"
PADDING = "none_boundary_patches_excluded"


def layout_facts(settings: Settings) -> dict:
    """Numbers and names a reader of the patches needs; all other settings stand under ``settings``."""
    return {
        "patch": {"size": settings.patch_size, "bytes": 3 * settings.patch_size**2, "dtype": "uint8", "channels": "RGB", "padding": PADDING},
        "coordinate_space": COORDINATE_SPACE,
        "transforms": list(TRANSFORMS),
    }


def write_csv(rows: DataFrame, target: str, columns: list[str]) -> None:
    """CSV with exactly these columns; extra ones are dropped."""
    rows.select(*columns).write.mode("errorifexists").option("header", True).option("escape", '"').option(
        "emptyValue", "").csv(target)


def write_json(rows: DataFrame, target: str) -> None:
    rows.write.mode("errorifexists").json(target)


def read_patches(spark: SparkSession, output: str, size: int) -> DataFrame:
    return spark.read.schema(PATCH_SCHEMA).parquet(f"{output}/patches_{size}")


def write_patches(patches: DataFrame, output: str, size: int) -> DataFrame:
    """Write patches by split and label, large labels rebalanced over many files; return them as read back."""
    parts = patches.select("patch_id", "sha256", "pixels", "split", "fine_label").hint("rebalance", "split", "fine_label")
    parts.write.mode("errorifexists").partitionBy("split", "fine_label").option(
        "maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{output}/patches_{size}")
    return read_patches(patches.sparkSession, output, size)


def write_document(spark: SparkSession, document: dict, target: str) -> None:
    line = json.dumps(document, ensure_ascii=False)
    spark.range(1).select(F.lit(line).alias("value")).coalesce(1).write.mode("errorifexists").text(target)


def mark_failed(spark: SparkSession, output: str) -> None:
    note = {"status": "incomplete_do_not_use", "failed_at": datetime.now(timezone.utc).isoformat()}
    write_document(spark, note, f"{output}/BUILD_FAILED.json")


def published_files(files: DataFrame) -> DataFrame:
    """Status names of the published record."""
    return files.withColumn("status", F.when(F.col("status") == "mapped", "used").otherwise(F.col("status")))


def table_digest(rows: DataFrame, columns: list[str]) -> str:
    """Digest of a set of rows that does not depend on their order or partitions."""
    return digest_text(rows, row_digest(columns))[0]


def grouped_totals(points: DataFrame, samples: DataFrame, files: DataFrame) -> dict[str, dict]:
    """Samples by split, class and subtype and by fine label, points left out by reason, points supplied by label: one job.

    Every group is limited by the taxonomy, the splits or the rules.
    """
    def part(rows: DataFrame, kind: str, n: Column, *keys: Column) -> DataFrame:
        names = [f"k{place}" for place in range(4)]
        filled = [*keys, *[F.lit(None).cast("string")] * (4 - len(keys))]
        return rows.groupBy(*(key.alias(name) for key, name in zip(filled, names))).agg(n.cast("bigint").alias("n")).select(
            F.lit(kind).alias("kind"), *names, "n")

    rows, supplied = F.count(F.lit(1)), F.sum(F.coalesce("point_count", F.lit(0)))
    subtype = F.coalesce(F.nullif(F.col("subtype"), F.lit("")), F.lit("-"))
    told = part(samples, "samples", rows, F.col("split"), F.col("label"), subtype, F.col("fine_label")).unionByName(
        part(points.filter("status <> 'included'"), "excluded", rows, F.col("reason"))).unionByName(
        part(files.filter("status = 'used'"), "supplied", supplied, F.col("fine_label"))).collect()
    found: dict[str, dict] = {"nested": {}, "labels": {}, "excluded": {}, "supplied": {}}
    for row in sorted(told, key=lambda row: tuple((key is not None, key or "") for key in (row.k0, row.k1, row.k2, row.k3))):
        if row.kind == "samples":
            found["nested"].setdefault(row.k0, {}).setdefault(row.k1, {})[row.k2] = row.n
            found["labels"][row.k3] = found["labels"].get(row.k3, 0) + row.n
        else:
            found[row.kind][row.k0] = row.n
    found["labels"] = dict(sorted(found["labels"].items()))
    return found


def counts(seen: dict[str, dict], grouped: dict[str, dict]) -> dict:
    """Bounded totals of the dataset: ``seen`` while its tables were written, and grouped."""
    return {
        "patches": seen["samples"]["n"],
        "by_split_class_subtype": grouped["nested"],
        "by_fine_label": grouped["labels"],
        "provider_points_in_used_roi_files": grouped["supplied"],
        "unique_points": seen["points"]["n"],
        "duplicate_point_refs": seen["points"]["duplicates"] or 0,
        "excluded_points_by_reason": grouped["excluded"],
        "images": seen["images"]["n"],
    }


def watched(rows: DataFrame, seen: dict[str, Observation], name: str, **metrics: Column) -> DataFrame:
    """``rows`` whose count and other metrics are taken while they are written, above any sort (a sort samples its input)."""
    seen[name] = Observation(name)
    return rows.observe(seen[name], F.count(F.lit(1)).alias("n"), *(metric.alias(key) for key, metric in metrics.items()))


def publish(spark: SparkSession, output: str, *, files: DataFrame, images: DataFrame, points: DataFrame,
            refs: DataFrame, samples: DataFrame, patches: DataFrame, order: list[str], settings: Settings,
            taxonomy: Taxonomy, facts: dict, started: str) -> dict:
    """Write everything beside the patches and return the manifest."""
    files, seen = published_files(files), {}
    write_csv(watched(samples.orderBy("path"), seen, "samples"), f"{output}/samples.csv", SAMPLE_COLUMNS)
    write_csv(watched(points.orderBy(*order), seen, "points", duplicates=F.sum(F.col("ref_count") - 1)), f"{output}/points.csv", POINT_COLUMNS)
    flat = files.withColumns({"contrast_probe": F.to_json("contrast_probe"), "warnings": F.array_join("warnings", ";")})
    write_csv(flat.orderBy("relpath"), f"{output}/roi_files.csv", FILE_COLUMNS)
    of_image = files.filter(F.col("image").isNotNull() & F.col("coordinate_transform").isNotNull() |
                            (F.col("reason") == "coordinate_grid_undetermined"))
    write_json(of_image.select("image", "relpath").orderBy("image", "relpath"), f"{output}/image_files.json")
    record = images.withColumn("relpath", F.col("image")).join(
        R.image_totals(points), "image", "left").drop("path", "twin_path", "offsets", "rows_per_strip", "strips", "image")
    write_json(watched(record.orderBy("relpath"), seen, "images"), f"{output}/images.json")
    write_lineage(refs, f"{output}/point_refs")
    write_json(R.excluded_files(files), f"{output}/excluded_roi_files.json")
    write_json(files.select("relpath", "sha256"), f"{output}/roi_file_sha256.json")
    write_json(images.select(F.col("image").alias("relpath"), "sha256", "bytes", F.col("jpeg_pair.sha256").alias("jpeg_sha256"),
                             "pixel_source", "pixel_check"), f"{output}/sources.json")
    chosen = R.sample_per_label(samples, "patch_id", settings.preview_per_label)
    # A few rows per label, so the patches are filtered by broadcast.
    chosen = F.broadcast(chosen.select("fine_label", "rank", "patch_id", "split", "area", "stage"))
    patches.select("patch_id", "pixels").join(chosen, "patch_id").write.parquet(f"{output}/preview_samples")
    R.stretch(R.mean_patch(patches)).write.parquet(f"{output}/preview_means")
    grouped = grouped_totals(points, samples, files)
    rare = {label: grouped["labels"].get(label, 0) for label in taxonomy.fine_labels}
    manifest = {
        **CONTRACT, "schema": SCHEMA_NAME, "schema_version": SCHEMA_VERSION,
        "started_at": started, "created_at": datetime.now(timezone.utc).isoformat(),
        "classes": list(taxonomy.classes), "subtypes": {name: list(subs) for name, subs in taxonomy.subtypes.items()},
        "fine_labels": list(taxonomy.fine_labels), **layout_facts(settings),
        "counts": counts({name: metrics.get for name, metrics in seen.items()}, grouped),
        "rare_fine_labels_under_300" if settings.rare_below == 300 else f"rare_fine_labels_under_{settings.rare_below}":
            {label: n for label, n in rare.items() if n < settings.rare_below},
        "samples_digest": table_digest(samples, SAMPLE_COLUMNS),
        "files": {"samples": "samples.csv", "points": "points.csv", "roi_files": "roi_files.csv", "images": "images.json",
                  "patches": f"patches_{settings.patch_size}", "point_refs": "point_refs", "image_files": "image_files.json",
                  "excluded_roi_files": "excluded_roi_files.json", "roi_file_sha256": "roi_file_sha256.json",
                  "sources": "sources.json", "preview_samples": "preview_samples", "preview_means": "preview_means"},
        **facts,
    }
    write_document(spark, manifest, f"{output}/manifest.json")
    seal(spark, output)
    return manifest


def write_lineage(refs: DataFrame, target: str) -> None:
    """Complete lineage: every supplied point with the unique point it belongs to."""
    lineage = refs.select("image", "fine_label", F.col("key_x").alias("x"), F.col("key_y").alias("y"), "roi", "index")
    point_lineage(lineage, ["index"], ["roi"]).select("point_id", "roi", "index").write.mode("errorifexists").parquet(target)


def seal(spark: SparkSession, output: str) -> None:
    """Digest of every published file except the seal itself, and of the byte ranges of files above one range."""
    large = listing(spark, output, hidden=False).filter((F.col("bytes") > RANGE_BYTES) & ~F.col("relpath").startswith("output_ranges/"))
    range_digests(large).write.mode("overwrite").parquet(f"{output}/output_ranges")
    file_digests(listing(spark, output, hidden=False)).write.mode("errorifexists").parquet(f"{output}/output_hashes")
