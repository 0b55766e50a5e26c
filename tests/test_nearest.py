"""Nearest points without a radius against every distance."""

import re

import numpy as np
import pyarrow as pa
import pytest

from markfield.operators import nearest


def brute(pixels, points):
    found = {}
    for image, x, y in pixels:
        far = [np.sqrt((x - a) ** 2 + (y - b) ** 2) for other, a, b in points if other == image and None not in (a, b, x, y)]
        found[image, x, y] = min(far, default=None)
    return found


def scene(seed, number):
    """A dense cluster, a thin line, scattered and very far points, and pixels all over."""
    rng = np.random.default_rng(seed)
    cluster = rng.normal(300, 4, (number, 2))
    line = np.column_stack([np.linspace(-900, 2_000, number // 4), np.full(number // 4, 700.25)])
    far = np.array([[30_000.5, -20_000.25], [30_000.5, -20_000.25]])
    points = [("a", *map(float, p)) for p in np.vstack([cluster, line])] + [("b", *map(float, p)) for p in far]
    points += [("c", 5.0, None), (None, 1.0, 1.0)]
    spots = {(int(x), int(y)) for x, y in np.vstack([rng.integers(-2_000, 2_500, (150, 2)), rng.integers(280, 320, (150, 2)), [[12_000, 9_000]]])}
    pixels = [(image, x + 0.5, y + 0.5) for x, y in sorted(spots) for image in "ab"] + [("c", 0.5, 0.5), ("d", 0.5, 0.5), ("a", None, 0.5)]
    return pixels, points


@pytest.mark.parametrize("limits", [{}, {"part_rows": 40}, {"side": 2, "growth": 2}])
def test_equals_every_distance(spark, limits):
    pixels, points = scene(1, 1_200)
    schema = "image string, x double, y double"
    found = nearest.nearest_point_distance(spark.createDataFrame(pixels, schema), spark.createDataFrame(points, schema), **limits).collect()
    assert len(found) == len(pixels)
    assert {(r.image, r.x, r.y): r.distance for r in found} == brute(pixels, points)


def test_thinning_keeps_what_can_be_nearest(spark):
    rng = np.random.default_rng(3)
    points = rng.uniform(0, 64, (20_000, 2))
    frame = spark.createDataFrame([("i", float(x), float(y)) for x, y in points], "image string, x double, y double")
    kept = np.array([(r.x, r.y) for r in nearest.thinned(frame, 64).collect()])
    assert len(kept) < len(points) / 10
    turn = np.linspace(0, 2 * np.pi, 720)
    for reach in (64.001 + 64, 300, 10_000):
        for x, y in np.column_stack([32 + reach * np.cos(turn), 32 + reach * np.sin(turn)]):
            assert np.hypot(*(points - [x, y]).T).min() == np.hypot(*(kept - [x, y]).T).min()


def test_empty(spark):
    none = spark.createDataFrame([], "image string, x double, y double")
    one = spark.createDataFrame([("a", 0.5, 0.5)], "image string, x double, y double")
    assert nearest.nearest_point_distance(none, one).count() == 0
    assert [tuple(r) for r in nearest.nearest_point_distance(one, none).collect()] == [("a", 0.5, 0.5, None)]


def test_small_groups_share_a_table_and_long_ones_cross_batches():
    keys = ["a"] * 2 + ["b"] * 9 + [None] * 2 + [f"k{n}" for n in range(40)]
    rows = pa.table({"image": pa.array(keys, pa.string()), "n": np.arange(len(keys))})
    for size in (1, 4, 7, 60):
        met, tables = [], 0
        for table, starts in nearest.whole_groups(rows.to_batches(size), ["image"]):
            tables += 1
            met += [table.column("n").to_pylist()[first:last] for first, last in zip(starts, [*starts[1:], len(table)])]
        assert [[keys[n] for n in group] for group in met] == [["a"] * 2, ["b"] * 9, [None] * 2, *[[f"k{n}"] for n in range(40)]]
        assert [n for group in met for n in group] == list(range(len(keys)))
        assert size == 1 or tables <= -(-len(keys) // size) + 1


def test_tasks_of_the_near_join_follow_the_counted_rows(spark, monkeypatch):
    from markfield.operators import neighbors, skew
    monkeypatch.setattr(neighbors, "row_partitions", lambda spark, rows: skew.row_partitions(spark, rows, 500))
    pixels = spark.range(10_000).selectExpr("substring(concat('a', id), 1, 1) AS image", "id % 100 + 0.5D AS x", "floor(id / 100) + 0.5D AS y")
    points = spark.createDataFrame([("a", 10.25, 20.5)] * 3 + [("b", 1.0, 1.0)], "image string, x double, y double")
    for count in (None, 10_000):
        found = neighbors.nearest_distance(pixels, points, 2.0, count)
        plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\)", plan)
        assert dealt and set(dealt) == {str(-(-(10_000 + 2 * 25) // 500))}
        told = {(r.x, r.y): r.distance for r in found.collect()}
        assert len(told) == 10_000
        for (x, y), distance in told.items():
            real = np.hypot(x - 10.25, y - 20.5)
            assert distance == (pytest.approx(real) if real <= 2 else None)
