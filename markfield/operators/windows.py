"""Fetching pixel windows around points from rasters stored as scan lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.functions.pixels import row_slice
from markfield.operators.skew import lookup_join


def window_slices(boxes: DataFrame, rows: DataFrame, keys: Sequence[str], height: Column, width: Column) -> DataFrame:
    """``keys, row_no, part``: the bytes of every row of every box.

    ``boxes``: ``keys, image, left, top``. Each box asks for its rows by number, so a
    raster row is shuffled once however many boxes cross it, and rows crossed by very
    many boxes are spread by :func:`lookup_join`. Only the slice leaves the join.
    """
    wanted = boxes.select(*keys, "image", "left", F.explode(
        F.sequence(F.col("top").cast("int"), (F.col("top") + height - 1).cast("int"))).alias("row_no"))
    met = lookup_join(wanted, rows.select("image", "row_no", "px"), ["image", "row_no"], keys, how="inner",
                      strategy="merge")
    return met.select(*keys, "row_no", row_slice(F.col("px"), F.col("left"), width).alias("part"))


def crop(boxes: DataFrame, rows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``keys, pixels``: raw RGB bytes of the ``size`` x ``size`` box of each key.

    A box is ``size`` short slices, so the gathered group is bounded by the patch.
    """
    slices = window_slices(boxes, rows, keys, F.lit(size), F.lit(size))
    ordered = F.array_sort(F.collect_list(F.struct("row_no", "part")))
    joined = F.aggregate(F.transform(ordered, lambda s: s["part"]), F.lit(b""), lambda acc, part: F.concat(acc, part))
    return slices.groupBy(*keys).agg(joined.alias("pixels"))
