"""Dominance counts against every comparison."""

import numpy as np
import pytest

from markfield.operators import counting


def brute(points, asks):
    found = {}
    for key, ask, x, y in asks:
        own = [(a, b) for other, a, b in points if other == key]
        found[ask] = (len(own), sum(a < x for a, _ in own), sum(b < y for _, b in own), sum(a < x and b < y for a, b in own))
    return found


@pytest.mark.parametrize("limit", [100_000, 60, 7])
def test_counts(spark, limit):
    rng = np.random.default_rng(limit)
    spots = np.concatenate([rng.normal(0, 1, (300, 2)), rng.integers(-2, 3, (300, 2)), np.zeros((100, 2))])
    points = [("abc"[n % 7 // 3], float(x), float(y)) for n, (x, y) in enumerate(spots)]
    corners = np.concatenate([rng.normal(0, 1, (200, 2)), rng.integers(-2, 3, (200, 2)), [[np.inf, 0], [0, np.inf], [np.inf, np.inf]]])
    asks = [("abcd"[n % 4], n, float(x), float(y)) for n, (x, y) in enumerate(corners)]
    found = counting.dominated(spark.createDataFrame(points, "key string, x double, y double"),
                               spark.createDataFrame(asks, "key string, ask bigint, x double, y double"), ["key"], limit=limit).collect()
    assert len(found) == len(asks)
    got = {r.ask: (r.total, r.below_x, r.below_y, r.below) for r in found}
    want = brute(points, asks)
    assert {a: (v, got[a]) for a, v in want.items() if got[a] != v} == {}


def test_prefixes_of_a_sequence():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 37, 64):
        values = rng.integers(0, 20, size)
        tree = counting.Prefixes(values)
        first, bound = np.repeat(np.arange(size + 1), 22), np.tile(np.append(np.arange(21), 99), size + 1)
        assert tree.below(first, bound).tolist() == [
            int((values[:k] < b).sum()) for k, b in zip(first, bound)]


@pytest.mark.parametrize("limit", [100_000, 40])
def test_a_row_stands_for_several_points(spark, limit):
    rng = np.random.default_rng(5)
    rows = [("ab"[n % 2], float(x), float(y), int(w)) for n, (x, y, w) in enumerate(zip(*rng.integers(0, 30, (2, 400)), rng.integers(1, 50, 400)))]
    asks = [("ab"[n % 2], n, float(x), float(y)) for n, (x, y) in enumerate(rng.integers(-1, 32, (200, 2)))]
    found = counting.dominated(spark.createDataFrame(rows, "key string, x double, y double, weight bigint"),
                               spark.createDataFrame(asks, "key string, ask bigint, x double, y double"), ["key"], limit=limit).collect()
    want = brute([(key, x, y) for key, x, y, weight in rows for _ in range(weight)], asks)
    assert {r.ask: (r.total, r.below_x, r.below_y, r.below) for r in found} == want


def test_points_of_a_place_are_counted_once(spark, monkeypatch):
    from markfield.operators import neighbors

    seen = []
    monkeypatch.setattr(neighbors, "dominated", lambda points, asks, *a, **k: seen.append((points.count(), asks.count())) or counting.dominated(points, asks, *a, **k))
    rng = np.random.default_rng(8)
    rows = [("i", str(n), "ab"[n % 2] if n else None, float(x) + 0.5, float(y) / 2) for n, (x, y) in enumerate(rng.integers(0, 12, (4_000, 2)))]
    found = neighbors.box_neighbors(spark.createDataFrame(rows, "image string, point_id string, fine_label string, x double, y double"),
                                    10, 6, cell_limit=50, task_rows=100).collect()
    assert max(points for points, _ in seen) <= 2 * 12 * 12 and max(asks for _, asks in seen) <= 16 * 2 * 12 * 12
    x, y, label = np.array([r[3] for r in rows]), np.array([r[4] for r in rows]), np.array([r[2] or "" for r in rows])
    assert len(found) == len(rows)
    for r in found[::37]:
        n = int(r.point_id)
        dx, dy = abs(x - x[n]), abs(y - y[n])
        named = (label != "") & (label[n] != "")
        near, same = named & (dx < 5) & (dy < 5), label == label[n]
        assert tuple(r)[2:] == ((near & same).sum() - (label[n] != ""), (near & ~same).sum(), (named & ~same & (dx < 3) & (dy < 3)).sum())
