"""Spatial counts around points: box neighbours and near-point tests.

Both replace an all-against-all comparison by an equi-join on grid cells. Box counts
treat crowded cells apart: a box is made up of one corner in each of the nine cells around
its point, and the points below all corners are counted at once (``counting``), in
n log n steps and without pairs, however many points a cell holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.operators.counting import LIMIT, dominated
from markfield.operators.skew import lookup_join, row_partitions, settle

CELL_LIMIT = 1_500
BROADCAST_CELLS = 20_000
CELL = ["image", "cx", "cy"]
COUNTS = ["neighbors_same_label_in_patch", "neighbors_other_label_in_patch", "neighbors_other_label_in_center"]


def _around(x: str, y: str) -> Column:
    """The 3x3 cells around a cell."""
    steps = F.sequence(F.lit(-1), F.lit(1))
    return F.flatten(F.transform(steps, lambda dx: F.transform(
        steps, lambda dy: F.struct((F.col(x) + dx).alias("cx"), (F.col(y) + dy).alias("cy")))))


def _spread_cells(rows: DataFrame, x: str = "cx", y: str = "cy") -> DataFrame:
    keep = [c for c in rows.columns if c not in (x, y)]
    return rows.select(*keep, F.explode(_around(x, y)).alias("_c")).select(*keep, "_c.cx", "_c.cy")


def box_neighbors(points: DataFrame, patch: int = 128, center: int = 32, *, cell_limit: int = CELL_LIMIT,
                  task_rows: int = LIMIT) -> DataFrame:
    """Neighbour counts of every point of an image within two open boxes.

    ``points``: ``image, point_id, fine_label`` (strings), ``x, y`` (unrounded). Returns ``image,
    point_id`` and the three count columns. Equal to comparing every pair of points of
    an image with strict ``abs(dx) < size/2 and abs(dy) < size/2``.
    """
    half = patch / 2
    cells = points.select(
        "image", "point_id", "fine_label", "x", "y",
        F.floor(F.col("x") / half).cast("bigint").alias("cx"),
        F.floor(F.col("y") / half).cast("bigint").alias("cy"))
    crowded = cells.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_limit).select(*CELL)
    found = crowded.limit(BROADCAST_CELLS + 1).count()
    if not found:
        return _pair_counts(cells, cells, patch, center)

    def tag(rows: DataFrame, table: DataFrame) -> DataFrame:
        if found <= BROADCAST_CELLS:
            return rows.join(F.broadcast(table), CELL, "left")
        return lookup_join(rows, table, CELL, ["point_id"])

    # Points with a crowded cell among their 3x3 cells (the zone) are counted by corners;
    # their partners lie at most one cell outside it.
    own = crowded.withColumn("crowded", F.lit(True))
    zone = _spread_cells(crowded).distinct().withColumn("zone", F.lit(True))
    reach = _spread_cells(zone.select(*CELL)).distinct().withColumn("near", F.lit(True))
    marks = reach.join(zone, CELL, "left").join(own, CELL, "left")
    tagged = settle(tag(cells, marks), "tagged_points")
    calm = tagged.filter(F.col("crowded").isNull()).drop("crowded", "near")
    sparse = _pair_counts(calm.filter(F.col("zone").isNull()).drop("zone"), calm.drop("zone"), patch, center)
    close = tagged.filter("near").drop("crowded", "near", "cx", "cy").fillna(False, ["zone"])
    dense = _dense_counts(close, half, {"same": COUNTS[0], "other": COUNTS[1]}, task_rows).unionByName(
        _dense_counts(close, center / 2, {"other": COUNTS[2]}, task_rows), allowMissingColumns=True)
    dense = dense.groupBy("image", "point_id").agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in COUNTS])
    return sparse.unionByName(dense)


def _pair_counts(queries: DataFrame, targets: DataFrame, patch: int, center: int) -> DataFrame:
    """Counts from an equi-join on squares of two by two cells; no cell of ``targets`` exceeds the cell limit.

    The three cells a side around a target lie in two squares, so a target is repeated to four squares and not to nine
    cells. Queries stay in their own, so the grouping needs no further shuffle.
    """
    def squares(cell: str) -> Column:
        return F.sequence(F.shiftright(F.col(cell) - 1, 1), F.shiftright(F.col(cell) + 1, 1))

    asking = queries.withColumns({"cx": F.shiftright("cx", 1), "cy": F.shiftright("cy", 1)})
    other_side = targets.select(
        "image", F.explode(squares("cx")).alias("_sx"), "cy", F.col("point_id").alias("q_id"), F.col("fine_label").alias("q_label"),
        F.col("x").alias("qx"), F.col("y").alias("qy")).withColumn("cy", F.explode(squares("cy"))).withColumnRenamed("_sx", "cx")
    dx, dy = F.abs(F.col("x") - F.col("qx")), F.abs(F.col("y") - F.col("qy"))
    same = F.col("fine_label") == F.col("q_label")
    not_self = F.col("point_id") != F.col("q_id")
    near = (dx < center / 2) & (dy < center / 2)
    # Repeating the targets escapes Spark's size estimates, which would broadcast them.
    pairs = asking.join(other_side.hint("merge"), CELL).filter((dx < patch / 2) & (dy < patch / 2))
    return pairs.groupBy(*CELL, "point_id").agg(
        F.count_if(same & not_self).alias(COUNTS[0]),
        F.count_if(~same).alias(COUNTS[1]),
        F.count_if(~same & near).alias(COUNTS[2]),
    ).drop("cx", "cy")


def _ordered(numbers: np.ndarray) -> np.ndarray:
    """Floating numbers as whole numbers in the same order, and back."""
    return numbers ^ (numbers >> 63 & np.int64(0x7FFFFFFFFFFFFFFF))


def _threshold(value: np.ndarray, half: float) -> np.ndarray:
    """The least number whose rounded difference to ``value`` is not below ``half``, by halving."""
    slack = (np.abs(value) + half) * 2.0**-50
    low, high = (_ordered((value + half + side * slack).view(np.int64)) for side in (-1, 1))
    while (low + 1 < high).any():
        middle = low + (high - low) // 2
        reached = _ordered(middle).view(np.float64) - value >= half
        low, high = np.where(reached, low, middle), np.where(reached, middle, high)
    return _ordered(high).view(np.float64)


def _corners(rows: DataFrame, half: float) -> DataFrame:
    """``no, fine_label, image, cx, cy, x, y, right, top, sign``: the corners whose counts make up each row's open box.

    In a cell to the left the box takes what is not below its corner (``right``), likewise with cells before it in ``y``
    (``top``). A cell of a side that is a power of two lies inside the boxes of its points; else it takes two corners.
    """
    exact = float(half).hex().startswith(("0x1.0000000000000p", "0x1p"))
    schema = ("no bigint, fine_label string, image string, cx bigint, cy bigint, x double, y double, `right` boolean, "
              "top boolean, sign int")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            sides = []
            for axis, cell in (("x", "cx"), ("y", "cy")):
                value, at = columns[axis].to_numpy(), columns[cell].to_numpy()
                low, high = np.nextafter(-_threshold(-value, half), np.inf), _threshold(value, half)
                endless = np.full(len(value), np.inf)
                own = [(at, endless, False, 1)] if exact else [(at, high, False, 1), (at, low, False, -1)]
                sides.append([(at - 1, low, True, 1), *own, (at + 1, high, False, 1)])
            n = batch.num_rows
            for cx, x, right, sign_x in sides[0]:
                for cy, y, top, sign_y in sides[1]:
                    yield pa.RecordBatch.from_arrays(
                        [columns["no"], columns["fine_label"], columns["image"], pa.array(cx), pa.array(cy), pa.array(x), pa.array(y),
                         pa.array(np.full(n, right)), pa.array(np.full(n, top)), pa.array(np.full(n, sign_x * sign_y, np.int32))],
                        names=[part.strip("` ").split(" ")[0].strip("`") for part in schema.split(",")])

    return rows.select("no", "fine_label", "image", "cx", "cy", "x", "y").mapInArrow(run, schema)


def _dense_counts(near: DataFrame, half: float, names: dict[str, str], limit: int) -> DataFrame:
    """Counts ``image, point_id, ...`` of the zone's points for one box size, from corners counted in nine cells.

    Points of one label at one place have the same counts, so a place is one row with its number of points.
    """
    place = ["image", "x", "y", "fine_label"]
    places = near.filter(F.col("fine_label").isNotNull()).groupBy(*place).agg(
        F.count(F.lit(1)).alias("weight"), F.bool_or("zone").alias("zone"))
    cells = places.select("*", F.floor(F.col("x") / half).cast("bigint").alias("cx"), F.floor(F.col("y") / half).cast("bigint").alias("cy"))
    points = settle(cells.withColumn("no", F.monotonically_increasing_id()), "numbered_places")
    asking = points.filter("zone")
    # A corner in a cell without points counts nothing.
    known = points.select(*CELL).distinct()
    asks = settle(_corners(asking, half).join(known.hint("merge"), CELL, "left_semi").withColumn(
        "ask", F.monotonically_increasing_id()), "corners")
    taken = (F.when(F.col("right") & F.col("top"), F.col("total") - F.col("below_x") - F.col("below_y") + F.col("below"))
             .when(F.col("right"), F.col("below_y") - F.col("below")).when(F.col("top"), F.col("below_x") - F.col("below"))
             .otherwise(F.col("below")))
    parts = [dominated(points, asks, [*CELL, *label], limit=limit).withColumn("same", F.lit(bool(label)))
             for label in ([], ["fine_label"])]
    signs = asks.select("ask", "no", "right", "top", "sign")
    found = parts[0].unionByName(parts[1]).join(signs.hint("merge"), "ask").groupBy("no").agg(
        F.sum(F.when(F.col("same"), F.col("sign") * taken).otherwise(0)).alias("same"),
        F.sum(F.when(~F.col("same"), F.col("sign") * taken).otherwise(0)).alias("all"))
    # A point lies inside its own box.
    values = {"same": F.col("same") - 1, "other": F.col("all") - F.col("same")}
    counts = asking.select("no", *place).join(found.hint("merge"), "no").select(
        *place, *[values[k].alias(v) for k, v in names.items()])
    return lookup_join(near.filter("zone").select("point_id", *place), settle(counts, "place_counts"), place, ["point_id"]).select(
        "image", "point_id", *names.values())


def near_points(pixels: DataFrame, points: DataFrame, radius: float = 2.0, pixel_count: int | None = None) -> DataFrame:
    """Per image: pixels tested, those with a point within ``radius``, and the fraction.

    ``pixels`` are distinct pixel centres ``image, x, y``. Images without points give a
    null fraction. ``pixel_count``: see :func:`nearest_distance`.
    """
    found = nearest_distance(pixels, points, radius, pixel_count)
    with_points = points.select("image").distinct().withColumn("_has", F.lit(True))
    counted = found.groupBy("image").agg(F.count(F.lit(1)).alias("tested"), F.count("distance").alias("near"))
    return counted.join(with_points, "image", "left").select(
        "image", "tested", "near", F.when(F.col("_has"), F.bround(F.col("near") / F.col("tested"), 4)).alias("near_fraction"))


def nearest_distance(pixels: DataFrame, points: DataFrame, radius: float, pixel_count: int | None = None) -> DataFrame:
    """Distance from each pixel centre to the nearest point within ``radius``, null beyond it.

    ``x, y`` of ``pixels`` are centres, ``i + 0.5``; the radius is at least half a pixel.
    Every place with points names the few centres in its reach, which go to as many tasks as the counted rows need: a
    task sorts about as many rows at every size. ``pixel_count`` is the number of pixels where the caller knows it.
    """
    def reach(q: str) -> Column:
        first, last = F.ceil(F.col(q) - (radius + 0.5)), F.floor(F.col(q) + (radius - 0.5))
        return F.sequence(first.cast("bigint"), last.cast("bigint"))

    # Whole numbers as keys: Spark would deal rows again for a join by floating ones.
    spark, place = pixels.sparkSession, ["image", "i", "j"]
    marks = settle(points.select("image", F.col("x").alias("qx"), F.col("y").alias("qy")).distinct(), "marked_places")
    named = marks.select("*", F.explode(reach("qx")).alias("i")).select("*", F.explode(reach("qy")).alias("j"))
    dx, dy = F.col("i") + 0.5 - F.col("qx"), F.col("j") + 0.5 - F.col("qy")
    found = named.select(*place, F.sqrt(dx * dx + dy * dy).alias("distance")).filter(F.col("distance") <= radius)
    per_place = math.ceil(2 * radius + 1) ** 2
    tasks = row_partitions(spark, marks.count() * per_place + (pixels.count() if pixel_count is None else pixel_count))
    nearest = found.repartition(tasks, *place).groupBy(*place).agg(F.min("distance").alias("distance"))
    centres = pixels.select("image", "x", "y", *[
        F.when(F.floor(axis) + 0.5 == F.col(axis), F.floor(axis)).cast("bigint").alias(key) for axis, key in (("x", "i"), ("y", "j"))])
    return centres.repartition(tasks, *place).join(nearest.hint("merge"), place, "left").select("image", "x", "y", "distance")
