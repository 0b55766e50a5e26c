"""Distance from pixels to their nearest point, however far it lies.

A grid search in growing rings: a pixel looks into the 3x3 cells around it, and a distance of at most one cell side is
proven, as no point outside these cells can be nearer. Pixels without proof go on with larger cells, so each round
moves only them and the points of cells they look into.

Before each further round the points are thinned. All pixels left are farther than one side from every point, and for
these a point is useless if each of eight cones around it holds another point of its small cell: whatever the
direction, that one is nearer. Only the outline of a dense place is left, found per Arrow batch before the shuffle. A
round's cells with many pixels or points are dealt into parts; distances of parts are reduced to a minimum, and inside
a part halves of the pixels' box keep only the points that can be nearest to it. No table of pairs is made.

Most groups are small, so tasks get them sorted and one after another, many in an Arrow batch, instead of one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.operators.neighbors import _spread_cells
from markfield.operators.skew import BROADCAST_KEYS, lookup_join, row_partitions, settle

#: Side of the first cells and its growth per round, powers of two so that cells are exact.
SIDE, GROWTH = 256, 8
PART_ROWS = 200_000
#: Distances computed at once; pixels compared without further halving.
BLOCK, FEW = 1 << 20, 48
CELL = ["image", "cx", "cy"]
PLACE = ["image", "x", "y"]


# ------------------------------------------------------------------ inside a task

def closest(px: np.ndarray, py: np.ndarray, qx: np.ndarray, qy: np.ndarray) -> np.ndarray:
    """Distance of each pixel to the nearest of the points; infinite without points."""
    found = np.full(len(px), np.inf)
    stack = [(np.arange(len(px)), np.arange(len(qx)))] if len(qx) else []
    while stack:
        pixels, points = stack.pop()
        x, y = px[pixels], py[pixels]
        low_x, high_x, low_y, high_y = x.min(), x.max(), y.min(), y.max()
        if len(pixels) <= FEW or len(pixels) * len(points) <= BLOCK // 64 or max(high_x - low_x, high_y - low_y) <= 0:
            step = max(1, BLOCK // len(points))
            for low in range(0, len(pixels), step):
                dx = x[low:low + step, None] - qx[points]
                dy = y[low:low + step, None] - qy[points]
                found[pixels[low:low + step]] = np.sqrt(dx * dx + dy * dy).min(1)
            continue
        wide = high_x - low_x >= high_y - low_y
        first = x <= (low_x + high_x) / 2 if wide else y <= (low_y + high_y) / 2
        for half in (pixels[first], pixels[~first]):
            if len(half):
                stack.append((half, points[_reachable(px[half], py[half], qx[points], qy[points])]))
    return found


def _reachable(px: np.ndarray, py: np.ndarray, qx: np.ndarray, qy: np.ndarray) -> np.ndarray:
    """Which points can be nearest to some place of the pixels' box; generous by more than rounding errs."""
    middle_x, middle_y = (px.min() + px.max()) / 2, (py.min() + py.max()) / 2
    across = np.hypot(px.max() - px.min(), py.max() - py.min())
    far = np.hypot(qx - middle_x, qy - middle_y)
    return far <= far.min() * (1 + 1e-9) + across * (1 + 1e-9) + 1e-9


def outline(cell: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points have a cone of 45 degrees without another point of their ``cell``; of equal points the first."""
    _, first = np.unique(np.column_stack([cell, x, y]), axis=0, return_index=True)
    cell, x, y = cell[first], x[first], y[first]
    kept = np.zeros(len(first), bool)
    for a, b in ((x, y), (y, x)):
        for sign_a in (1, -1):
            for sign_b in (1, -1):
                up, out = sign_b * b, sign_a * a - sign_b * b
                order = np.lexsort((-out, -up, cell))
                # Running maxima inside a cell: ranks of ``out``, lifted by the cell's place in the order.
                rank = np.unique(out, return_inverse=True)[1][order]
                lift = np.cumsum(np.concatenate([[0], np.diff(cell[order]) != 0])) * (len(first) + 1)
                value = rank + lift + 1
                before = np.concatenate([[0], np.maximum.accumulate(value)[:-1]])
                kept[order[value > np.maximum(before, lift)]] = True
    return np.sort(first[kept])


def _starts(rows: pa.Table | pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where the groups of sorted rows begin, the first place included; nulls are equal."""
    n = rows.num_rows
    new = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        column = rows.column(key)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        before, after = column.slice(0, n - 1), column.slice(1)
        unlike = pc.fill_null(pc.not_equal(before, after), False).to_numpy(zero_copy_only=False)
        new |= unlike | (before.is_null().to_numpy(zero_copy_only=False) != after.is_null().to_numpy(zero_copy_only=False))
    return np.concatenate([[0], np.flatnonzero(new) + 1]) if n else np.zeros(0, np.int64)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole groups, with the places where groups begin; a row is copied once."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = int(_starts(batch, keys)[-1])
        if not last and held:
            edge = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
            if len(_starts(edge, keys)) == 1:
                held.append(batch)
                continue
        whole = [*held, batch.slice(0, last)]
        if sum(part.num_rows for part in whole):
            rows = pa.Table.from_batches(whole).combine_chunks()
            yield rows, _starts(rows, keys)
        held = [batch.slice(last)]
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, _starts(rows, keys)


# ------------------------------------------------------------------ rounds

def _cell(name: str, side: float) -> Column:
    return F.floor(F.col(name) / F.lit(float(side))).cast("bigint")


def thinned(points: DataFrame, side: float) -> DataFrame:
    """The points that can be nearest to some place farther than ``side`` from all points."""
    schema = "image string, x double, y double, cx bigint, cy bigint"

    def kept(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
        keys = rows.select(CELL).to_pandas()
        cell = keys.groupby(CELL, sort=False, dropna=False).ngroup().to_numpy().astype(np.float64)
        return outline(cell, rows.column("x").to_numpy(), rows.column("y").to_numpy())

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.take(pa.array(kept(batch)))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, CELL):
            cell = np.zeros(rows.num_rows)
            cell[starts[1:]] = 1
            at = outline(np.cumsum(cell), rows.column("x").to_numpy(), rows.column("y").to_numpy())
            yield from rows.take(pa.array(at)).to_batches()

    keyed = points.select("image", "x", "y", _cell("x", side / 2).alias("cx"), _cell("y", side / 2).alias("cy"))
    met = keyed.mapInArrow(local, schema).repartition(*CELL).sortWithinPartitions(*CELL)
    return met.mapInArrow(whole, schema).select(*PLACE)


def _round(pixels: DataFrame, points: DataFrame, side: float, part_rows: int) -> DataFrame:
    """``image, x, y, distance`` to the points of the 3x3 cells around each pixel, null without any."""
    asked = pixels.withColumns({"cx": _cell("x", side), "cy": _cell("y", side)})
    cells = settle(asked.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("n_ask"), F.count(F.lit(1)).alias("rows")), "open_cells")
    rows = cells.agg(F.sum("rows")).head()[0]
    cells = cells.drop("rows")
    few = cells.count() <= BROADCAST_KEYS
    offered = _spread_cells(points.withColumns({"cx": _cell("x", side), "cy": _cell("y", side)}))
    offered = settle(offered.join(F.broadcast(cells) if few else cells.hint("merge"), CELL), "offered_points")
    counts = offered.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("n_give"))
    cells = settle(cells.join(counts.hint("merge"), CELL, "left").withColumn("n_give", F.coalesce("n_give", F.lit(1))), "cell_parts")
    crowded = cells.filter("n_ask > 1 or n_give > 1").select(*CELL, F.col("n_ask").alias("asks"), F.col("n_give").alias("gives"))
    crowded = settle(crowded, "crowded_cells")
    parted = crowded.count()

    def dealt(rows: DataFrame, own: str, other: str, names: list[str]) -> DataFrame:
        """Rows dealt over the parts of their own side and repeated to those of the other."""
        if not parted:
            return rows.select(*CELL, "x", "y", F.lit(0).alias("own"), F.lit(0).alias("other")).toDF(*names)
        joined = rows.drop("n_ask").join(F.broadcast(crowded) if parted <= BROADCAST_KEYS else crowded.hint("merge"), CELL, "left")
        return joined.select(*CELL, "x", "y", F.pmod(F.xxhash64("x", "y"), F.coalesce(own, F.lit(1))).cast("int").alias("own"), F.explode(
            F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)).alias("other")).toDF(*names)

    names = [*CELL, "x", "y"]
    left = dealt(asked, "asks", "gives", [*names, "ask", "give"]).withColumn("asks", F.lit(True))
    right = dealt(offered, "gives", "asks", [*names, "give", "ask"]).withColumn("asks", F.lit(False))
    group = [*CELL, "ask", "give"]

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met, starts in whole_groups(batches, group):
            x, y = met.column("x").to_numpy(), met.column("y").to_numpy()
            asks = met.column("asks").to_numpy(zero_copy_only=False)
            distance = np.full(met.num_rows, np.inf)
            given = np.concatenate([[0], np.cumsum(~asks)])
            for first, last in zip(starts.tolist(), [*starts[1:].tolist(), met.num_rows]):
                # The points of a group stand before its pixels.
                middle = first + int(given[last] - given[first])
                if first < middle < last:
                    distance[middle:last] = closest(x[middle:last], y[middle:last], x[first:middle], y[first:middle])
            told = met.select(PLACE).append_column("distance", pa.array(distance, mask=np.isinf(distance)))
            yield from told.filter(pa.array(asks)).combine_chunks().to_batches()

    tasks = row_partitions(pixels.sparkSession, rows + offered.count())
    met = left.unionByName(right).repartition(tasks, *group).sortWithinPartitions(*group, "asks")
    found = met.mapInArrow(solve, "image string, x double, y double, distance double")
    return found.groupBy(*PLACE).agg(F.min("distance").alias("distance")) if parted else found


def nearest_point_distance(pixels: DataFrame, points: DataFrame, *, side: int = SIDE, growth: int = GROWTH,
                           part_rows: int = PART_ROWS) -> DataFrame:
    """``image, x, y, distance``: each pixel's distance to the nearest point of its image.

    ``pixels`` are distinct places ``image, x, y``; points may repeat. Pixels of images without points, and pixels or
    points with a null, have no distance. ``side`` and ``growth`` are powers of two; they and ``part_rows`` change the
    work, never the result.
    """
    marks = settle(points.select(*PLACE).na.drop().distinct(), "marks")
    pixels = settle(pixels.select(*PLACE), "asked_pixels")  # counted and read again below, made once
    rows = settle(lookup_join(pixels, marks.select("image").distinct().withColumn("_has", F.lit(True)), ["image"],
                              ["x", "y"]), "pixels")
    reachable = F.coalesce("_has", F.lit(False)) & F.col("x").isNotNull() & F.col("y").isNotNull()
    done = rows.filter(~reachable).select(*PLACE, F.lit(None).cast("double").alias("distance"))
    left = rows.filter(reachable).select(*PLACE)
    while not left.isEmpty():
        found = settle(_round(left, marks, side, part_rows), "distances")
        proven = F.coalesce(F.col("distance") <= side, F.lit(False))
        done, left = done.unionByName(found.filter(proven)), found.filter(~proven).select(*PLACE)
        # Only images with pixels left need their points.
        marks = settle(thinned(marks.join(left.select("image").distinct().hint("merge"), "image", "left_semi"), side), "outline")
        side *= growth
    return done
