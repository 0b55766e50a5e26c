"""Each check of a finished dataset fails on its own kind of damage."""

import json
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from markfield.operators.mapping import LITERAL_LIMIT, attach_value
from markfield.plans.build import build
from markfield.plans.publish import SAMPLE_COLUMNS, seal, table_digest, write_csv
from markfield.plans.validate import read_manifest, validate, validation_report
from markfield.sources.files import read_table_csv
from tests.support import write_points, write_tiff


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("small")
    rng = np.random.default_rng(0)
    for area in ("1", "2"):
        folder = root / "source" / f"{area} Area" / "before"
        write_tiff(folder / "before.tif", rng.integers(0, 255, (400, 400, 3), dtype=np.uint8))
        write_points(folder / "Before_BPD.roi", rng.uniform(100, 300, (5, 2)).round(1))
    build(spark, str(root / "source"), str(root / "out"))
    return root / "out"


def changed(spark, dataset, target, samples=None, manifest=None, reseal=True):
    """Copy of the dataset with edited samples or manifest, sealed again unless told not to."""
    shutil.copytree(dataset, target)
    for note in target.rglob("*.crc"):
        note.unlink()
    document = read_manifest(spark, str(dataset))
    if samples is not None:
        shutil.rmtree(target / "samples.csv")
        write_csv(samples, str(target / "samples.csv"), SAMPLE_COLUMNS)
        document["samples_digest"] = table_digest(samples, SAMPLE_COLUMNS)
    if manifest:
        manifest(document)
    part = next(Path(target / "manifest.json").glob("part-*"))
    part.write_text(json.dumps(document))
    if reseal:
        shutil.rmtree(target / "output_hashes")
        seal(spark, str(target))
    return str(target)


def rows(spark, dataset):
    return read_table_csv(spark, f"{dataset}/samples.csv")


def test_resealed_copy_passes(spark, dataset, tmp_path):
    copy = changed(spark, dataset, tmp_path / "c", rows(spark, dataset))
    assert validate(spark, copy)["patches"] == rows(spark, dataset).count() > 0


def test_schema(spark, dataset, tmp_path):
    copy = changed(spark, dataset, tmp_path / "c", manifest=lambda m: m.update(schema_version=2))
    with pytest.raises(ValueError, match="unsupported schema"):
        validate(spark, copy)
    report = validation_report(spark, copy).collect()
    assert [(r.check, r.passed) for r in report] == [("completed", True), ("schema", False)]


def test_samples_digest(spark, dataset, tmp_path):
    copy = changed(spark, dataset, tmp_path / "c", manifest=lambda m: m.update(samples_digest="0-0"))
    with pytest.raises(ValueError, match="samples.csv hash mismatch"):
        validate(spark, copy)


def test_seal(spark, dataset, tmp_path):
    copy = changed(spark, dataset, tmp_path / "c", manifest=lambda m: m.update(task="x"), reseal=False)
    with pytest.raises(ValueError, match="hash mismatch: manifest.json"):
        validate(spark, copy)


def test_unexpected_file(spark, dataset, tmp_path):
    copy = changed(spark, dataset, tmp_path / "c")
    (tmp_path / "c" / "extra.txt").write_text("x")
    assert validate(spark, copy)["status"] == "passed"
    with pytest.raises(ValueError, match="unexpected file: extra.txt"):
        validate(spark, copy, unexpected_files=True)


def test_patch_bytes(spark, dataset, tmp_path):
    edited = rows(spark, dataset).withColumn("sha256", F.sha2("patch_id", 256))
    with pytest.raises(ValueError, match="bad patch patches_128/"):
        validate(spark, changed(spark, dataset, tmp_path / "c", edited))


def test_label_domain(spark, dataset, tmp_path):
    edited = rows(spark, dataset).withColumn("fine_label", F.lit("TED_z"))
    with pytest.raises(ValueError, match="unknown label TED_z"):
        validate(spark, changed(spark, dataset, tmp_path / "c", edited))


def test_split_leakage(spark, dataset, tmp_path):
    edited = rows(spark, dataset).withColumn("area", F.lit("1"))
    with pytest.raises(ValueError, match="areas in more than one split: 1"):
        validate(spark, changed(spark, dataset, tmp_path / "c", edited))


def test_count(spark, dataset, tmp_path):
    def fewer(document):
        document["counts"]["patches"] -= 1
    with pytest.raises(ValueError, match="patch count mismatch"):
        validate(spark, changed(spark, dataset, tmp_path / "c", manifest=fewer))


def test_default_split_map(spark, dataset):
    assert {(r.area, r.split) for r in rows(spark, dataset).collect()} == {("1", "train"), ("2", "val")}


def test_long_mappings_become_a_table(spark):
    values = {str(n): f"v{n}" for n in range(LITERAL_LIMIT + 5)}
    table = spark.range(LITERAL_LIMIT + 10).select(F.col("id").cast("string").alias("k"), "id")
    for mapping in (values, {"3": "v3"}, {}):
        got = {r.k: r.v for r in attach_value(table, "k", mapping, "v", "id").collect()}
        assert got == {str(n): mapping.get(str(n)) for n in range(LITERAL_LIMIT + 10)}
