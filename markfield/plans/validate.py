"""Check a finished dataset: marker, schema, digests, shapes, labels, splits, counts.

Samples and patches are scanned once; every problem found is one row of a table (:func:`violations`), of which a report
names the first of each check.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.config import SCHEMA_NAME, SCHEMA_VERSION, Taxonomy
from markfield.operators import findings as V
from markfield.operators import report as R
from markfield.operators.skew import job_folder, settle
from markfield.plans.publish import PATCH_SCHEMA, SAMPLE_COLUMNS, read_patches
from markfield.sources.files import exists, file_digests, listing, read_table_csv
from markfield.sources.ranges import changed_ranges, range_digests

#: Problems a report names for each check at most; the checks themselves cover all.
MOST_NAMED = 100
SAMPLE_SCHEMA = ", ".join(f"{c} string" for c in SAMPLE_COLUMNS)


class Check(NamedTuple):
    check: str
    problems: int
    details: list[str]

    @property
    def message(self) -> str | None:
        """What is wrong, or None. Splits are named together, of the others the first."""
        if not self.problems:
            return None
        if self.check != "splits":
            return self.details[0]
        more = self.problems - len(self.details)
        return "areas in more than one split: " + "; ".join(self.details) + (f" and {more} more" if more else "")


def read_manifest(spark: SparkSession, dataset: str) -> dict:
    return json.loads(spark.read.option("wholetext", True).text(f"{dataset}/manifest.json").head()[0])


def judged(spark: SparkSession, dataset: str, manifest: dict) -> DataFrame:
    """One narrow row a sample, written once; a table that is missing counts as empty."""
    size, samples = manifest["patch"]["size"], f"{dataset}/samples.csv"
    rows = read_table_csv(spark, samples, SAMPLE_SCHEMA) if exists(spark, samples) else spark.createDataFrame([], SAMPLE_SCHEMA)
    patches = read_patches(spark, dataset, size) if exists(spark, f"{dataset}/patches_{size}") else spark.createDataFrame([], PATCH_SCHEMA)
    taxonomy = Taxonomy({name: tuple(subs) for name, subs in manifest["subtypes"].items()})
    return settle(V.judged_samples(rows, patches, size, taxonomy, SAMPLE_COLUMNS), "judged")


def file_problems(spark: SparkSession, dataset: str, unexpected_files: bool) -> DataFrame:
    """``check, place, detail`` of recorded files that changed or are gone and, if asked for, of files nobody recorded."""
    recorded = spark.read.parquet(f"{dataset}/output_hashes")
    present = listing(spark, dataset, hidden=False).filter(~F.col("relpath").startswith("output_hashes/"))

    def told(rows: DataFrame, check: str, text: str) -> DataFrame:
        return rows.select(F.lit(check).alias("check"), F.col("relpath").alias("place"), F.concat(F.lit(text), "relpath").alias("detail"))

    found = told(R.hash_mismatches(recorded, file_digests(present)), "hashes", "hash mismatch: ")
    extra = present.join(recorded, "relpath", "left_anti")
    return found.unionByName(told(extra, "unexpected_files", "unexpected file: ")) if unexpected_files else found


def violations(spark: SparkSession, dataset: str, unexpected_files: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """``check, place, detail``: every problem of files, patches, labels and splits, written once. ``rows``: see :func:`judged`."""
    rows = judged(spark, dataset, read_manifest(spark, dataset)) if rows is None else rows
    found = V.sample_problems(rows).unionByName(V.area_problems(rows)).unionByName(file_problems(spark, dataset, unexpected_files))
    return settle(found, "violations")


def checks(spark: SparkSession, dataset: str, unexpected_files: bool = False) -> list[Check]:
    """All checks in order; stops where the dataset is unfinished or of another schema."""
    def one(check: str, good: bool, text: str) -> Check:
        return Check(check, int(not good), [] if good else [text])

    whole = not exists(spark, f"{dataset}/BUILD_FAILED.json") and exists(spark, f"{dataset}/output_hashes")
    told = [one("completed", whole, "dataset build failed; do not use")]
    if not whole:
        return told
    manifest = read_manifest(spark, dataset)
    known = (manifest.get("schema"), manifest.get("schema_version")) == (SCHEMA_NAME, SCHEMA_VERSION)
    told.append(one("schema", known, "unsupported schema"))
    if not known:
        return told

    rows = judged(spark, dataset, manifest)
    digest, number = V.digest_text(rows, "number")
    found: dict[str, Check] = {}
    named = V.first_problems(violations(spark, dataset, unexpected_files, rows), MOST_NAMED).collect()
    for row in sorted(named, key=lambda row: (row.check, row.rank)):
        found.setdefault(row.check, Check(row.check, row.problems, [])).details.append(row.detail)
    told.append(one("samples_digest", digest == manifest["samples_digest"], "samples.csv hash mismatch"))
    listed = ["hashes", "unexpected_files", "patches", "labels", "splits"] if unexpected_files else ["hashes", "patches", "labels", "splits"]
    told += [found.get(check, Check(check, 0, [])) for check in listed]
    told.append(one("count", number == manifest["counts"]["patches"], "patch count mismatch"))
    return told


def damaged_ranges(spark: SparkSession, dataset: str) -> DataFrame:
    """``relpath, range_no, start, length`` of the changed parts of files above one range, read by many tasks."""
    recorded = spark.read.parquet(f"{dataset}/output_ranges")
    known = listing(spark, dataset, hidden=False).join(recorded.select("relpath").distinct(), "relpath", "left_semi")
    return changed_ranges(recorded, range_digests(known))


def validation_report(spark: SparkSession, dataset: str, unexpected_files: bool = False) -> DataFrame:
    """Rows ``check, passed, detail, problems``; stops at checks that need an unreadable manifest."""
    with job_folder(spark):
        rows = [(told.check, not told.problems, told.message, told.problems) for told in checks(spark, dataset, unexpected_files)]
    return spark.createDataFrame(rows, "check string, passed boolean, detail string, problems bigint")


def validate(spark: SparkSession, dataset: str, unexpected_files: bool = False) -> dict:
    """Raise ``ValueError`` with the first failing check."""
    with job_folder(spark):
        for told in checks(spark, dataset, unexpected_files):
            if told.problems:
                raise ValueError(told.message)
    manifest = read_manifest(spark, dataset)
    return {"status": "passed", "patches": manifest["counts"]["patches"],
            "files_hashed": spark.read.parquet(f"{dataset}/output_hashes").count(),
            "scope": "files and tables agree with each other; whether a label is right is not checked"}
