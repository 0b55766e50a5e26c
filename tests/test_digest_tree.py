"""Row agreement through the digest tree: equal to comparing every line, and what it shuffles."""

import numpy as np
import pytest

from markfield.config import TRANSFORMS
from pyspark.sql import functions as F

from markfield.operators import agreement as A

FLIPS = {"identity": lambda a: a, "hflip": lambda a: a[:, ::-1], "vflip": lambda a: a[::-1], "rot180": lambda a: a[::-1, ::-1]}


def rows_of(spark, rasters, parts=3):
    told = [(name, n, len(raster), np.ascontiguousarray(row).tobytes()) for name, raster in rasters.items() for n, row in enumerate(raster)]
    return spark.createDataFrame(told, "image string, row_no int, height int, px binary").repartition(parts, "image")


def sizes_of(spark, rasters):
    return spark.createDataFrame([(name, raster.shape[1], raster.shape[0]) for name, raster in rasters.items()], "image string, width int, height int")


def scene(seed):
    """Equal twins, twins under every flip with damaged stretches, blank rasters and one of another size."""
    rng = np.random.default_rng(seed)
    own = {f"{name}-{damage}": rng.integers(0, 256, (37, 5, 3)).astype(np.uint8) for name in TRANSFORMS for damage in (0, 1, 9)}
    twins = {name: FLIPS[name.split("-")[0]](raster).copy() for name, raster in own.items()}
    for name, raster in own.items():
        damage = int(name.split("-")[1])
        raster[4:4 + damage] = 255
    own["blank"] = twins["blank"] = np.zeros((20, 4, 3), np.uint8)
    own["short"], twins["short"] = rng.integers(0, 9, (8, 4, 3)).astype(np.uint8), np.zeros((7, 4, 3), np.uint8)
    return own, twins


@pytest.mark.parametrize("block_rows", [1, 5, 256])
def test_equal_to_comparing_lines(spark, block_rows):
    own, twins = scene(6)
    found = A.row_agreement(rows_of(spark, own), rows_of(spark, twins), sizes_of(spark, own), sizes_of(spark, twins), block_rows=block_rows).collect()
    want = {}
    for name, raster in own.items():
        for flip in TRANSFORMS:
            other = FLIPS[flip](twins[name])
            want[name, flip] = round(float(np.mean([(a == b).all() for a, b in zip(raster, other)])), 6) if raster.shape == other.shape else 0.0
    assert {(r.image, r.transform): r.agreement for r in found} == want and len(found) == len(want)
    short = A.row_agreement(rows_of(spark, own), rows_of(spark, twins), sizes_of(spark, own), sizes_of(spark, twins), until_equal=True).collect()
    for name in own:
        told = [r.transform for r in short if r.image == name]
        equal = [n for n, flip in enumerate(TRANSFORMS) if want[name, flip] == 1.0]
        assert sorted(told) == sorted(TRANSFORMS[:equal[0] + 1] if equal else TRANSFORMS)
    assert {(r.image, r.transform): r.agreement for r in short}.items() <= want.items()


def test_equal_rasters_shuffle_one_row_each(spark):
    """Digests of a raster lying in one task meet in one row; no block or line is opened."""
    rng = np.random.default_rng(3)
    own = {str(n): rng.integers(0, 256, (200, 3, 3)).astype(np.uint8) for n in range(6)}
    rows = rows_of(spark, own, 2).cache()
    rows.count()
    lines, twins = A.leaf_digests(rows, rows)
    partial = A._own_nodes(lines)._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_xor" in partial
    nodes = A._own_nodes(lines).collect()
    assert len(nodes) == 6 and all(r.rows == 200 for r in nodes)
    status = spark.sparkContext.statusTracker()
    group = "digest-tree"
    spark.sparkContext.setJobGroup(group, group)
    A.row_agreement(rows, rows, sizes_of(spark, own), sizes_of(spark, own), until_equal=True).collect()
    stages = {stage for job in status.getJobIdsForGroup(group) for stage in status.getJobInfo(job).stageIds}
    store = spark._jsc.sc().statusStore()
    written = sum(store.lastStageAttempt(stage).shuffleWriteRecords() for stage in stages if status.getStageInfo(stage))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert written < 200  # 1,200 lines a side


def test_a_line_travels_to_two_places_with_short_digests(spark, monkeypatch):
    rng = np.random.default_rng(7)
    own = {name: rng.integers(0, 256, (6, 4, 3)).astype(np.uint8) for name in "abc"}
    twins = {"a": own["a"][::-1], "b": own["b"][:, ::-1].copy(), "c": own["c"].copy()}
    twins["c"][2] = 0
    rows = A.leaf_digests(rows_of(spark, own), rows_of(spark, twins))
    assert {len(row.digest) for row in rows[0].collect()} == {16}
    opened = spark.createDataFrame([(i, t, 0, 6) for i in "abc" for t in ("identity", "hflip", "vflip", "rot180")],
                                   "image string, transform string, block bigint, rows bigint")
    block = F.floor(F.col("row_no") / 256).alias("block")
    for some, want in ((opened, {("a", "vflip"): 6, ("b", "hflip"): 6, ("c", "identity"): 5}),
                       (opened.filter("image = 'c' AND transform = 'identity'"), {("c", "identity"): 5})):
        found = A._alike_lines(*rows, some, block)
        assert {(r.image, r.transform): r.n for r in found.collect()} == want
