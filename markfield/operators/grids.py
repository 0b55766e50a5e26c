"""Which pixel grid was a file drawn on: local contrast evidence and consensus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.config import CONTROL_SHIFTS, Settings
from markfield.functions.pixels import slice_moments
from markfield.operators.skew import exact_median, lookup_join, settle
from markfield.operators.windows import window_slices


def probe_margin(radius: int, shifts: Sequence[tuple[int, int]]) -> int:
    return radius + max(max(abs(dx), abs(dy)) for dx, dy in shifts)


def inside_margin(x: Column, y: Column, width: Column, height: Column, margin: int) -> Column:
    """The window at the point and at every shift lies inside the raster."""
    px, py = F.floor(x), F.floor(y)
    return (px >= margin) & (py >= margin) & (px < width - margin) & (py < height - margin)


def probe_windows(points: DataFrame, radius: int, shifts: Sequence[tuple[int, int]]) -> DataFrame:
    """One window box at the point (``shift`` 0) and one per control shift, no join."""
    offsets = F.array(*[
        F.struct(F.lit(number).alias("shift"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
        for number, (dx, dy) in enumerate([(0, 0), *shifts])])
    return points.withColumn("_o", F.explode(offsets)).select(
        *points.columns, F.col("_o.shift").alias("shift"),
        (F.floor("x") + F.col("_o.dx") - radius).cast("bigint").alias("left"),
        (F.floor("y") + F.col("_o.dy") - radius).cast("bigint").alias("top"))


def window_spread(points: DataFrame, rows: DataFrame, keys: Sequence[str], radius: int,
                  shifts: Sequence[tuple[int, int]]) -> DataFrame:
    """``keys, shift, spread``: n * sum(s^2) - (sum s)^2 of the channel sums in each window.

    The spread is a whole number that orders windows exactly like their standard
    deviation. Row moments are added up, so windows are never reassembled.
    """
    side = 2 * radius + 1
    boxes = probe_windows(points, radius, shifts)
    slices = window_slices(boxes, rows, [*keys, "shift"], F.lit(side), F.lit(side))
    sums = slices.select(*keys, "shift", slice_moments("part").alias("m")).groupBy(*keys, "shift").agg(
        F.sum("m.total").alias("total"), F.sum("m.squares").alias("squares"))
    spread = F.lit(side * side) * F.col("squares") - F.col("total") * F.col("total")
    return sums.select(*keys, "shift", spread.cast("bigint").alias("spread"))


def spread_to_std(spread: Column, radius: int) -> Column:
    """Population standard deviation of the channel means."""
    side = 2 * radius + 1
    return F.sqrt(spread.cast("double")) / F.lit(3.0 * side * side)


def contrast_ratio(points: DataFrame, rows: DataFrame, sizes: DataFrame, group: Sequence[str], *,
                   radius: int = 7, shifts: Sequence[tuple[int, int]] = CONTROL_SHIFTS) -> DataFrame:
    """Median window deviation at points over the pooled median at the shifted controls.

    ``points``: ``group..., point_no, image, x, y``; ``sizes``: ``image, width, height``.
    Returns ``group, points_used, median_std_points, median_std_controls, ratio`` for
    groups with at least one usable point. Groups may be of any size.
    """
    group = list(group)
    margin = probe_margin(radius, shifts)
    sized = lookup_join(points, sizes.select("image", "width", "height"), ["image"], [*group, "point_no"], how="inner")
    usable = sized.filter(inside_margin(F.col("x"), F.col("y"), F.col("width"), F.col("height"), margin)).select(
        *group, "point_no", "image", "x", "y")
    return ratio_of_spreads(window_spread(usable, rows, [*group, "point_no"], radius, shifts), group, radius)


def ratio_of_spreads(spreads: DataFrame, group: Sequence[str], radius: int) -> DataFrame:
    """Contrast per group from ``group, shift, spread`` (shift 0 is the point itself)."""
    # Fetching windows is the costly part and the median reads them twice.
    windows = settle(spreads.select(*group, (F.col("shift") > 0).alias("control"), "spread"), "window_spreads")
    medians = exact_median(windows, [*group, "control"], "spread").withColumn(
        "median", (spread_to_std(F.col("lower"), radius) + spread_to_std(F.col("upper"), radius)) / 2)
    control = F.col("control")
    sides = medians.groupBy(*group).agg(
        F.max(F.when(~control, F.col("n"))).alias("points_used"),
        F.max(F.when(~control, F.col("median"))).alias("at_points"),
        F.max(F.when(control, F.col("median"))).alias("at_controls"))
    ratio = F.when(F.col("at_controls") > 0, F.try_divide("at_points", "at_controls"))
    return sides.select(*group, "points_used",
                        F.bround("at_points", 3).alias("median_std_points"),
                        F.bround("at_controls", 3).alias("median_std_controls"),
                        F.bround(ratio, 4).alias("ratio"))


def grid_consensus(files: DataFrame) -> DataFrame:
    """Let undecided files take the only grid that contrast decided for their image and class.

    ``files``: ``relpath, image, label, transform, basis``. Overrides and single-candidate
    decisions are not evidence. Files left without a grid keep a null transform.
    """
    evidence = files.filter(F.col("transform").isNotNull() & F.col("basis").startswith("contrast_probe"))
    agreed = evidence.groupBy("image", "label").agg(
        F.min("transform").alias("_low"), F.max("transform").alias("_high"))
    agreed = agreed.filter(F.col("_low") == F.col("_high")).select("image", "label", F.col("_low").alias("_agreed"))
    joined = lookup_join(files, agreed, ["image", "label"], ["relpath"])
    inherits = F.col("transform").isNull() & F.col("_agreed").isNotNull()
    return joined.withColumn(
        "basis", F.when(inherits, "inherited_from_same_image_same_class_files").otherwise(F.col("basis"))
    ).withColumn("transform", F.coalesce("transform", "_agreed")).drop("_agreed")


def decided_files(probes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Grid decision per file from ``relation, identity_ratio, other_ratio, point_count, override``."""
    from markfield.functions.geometry import decide_grid, with_override

    decided = with_override(F.col("override"), decide_grid(
        F.col("relation"), F.col("identity_ratio"), F.col("other_ratio"), F.col("point_count"), settings))
    return probes.withColumn("_d", decided).withColumn("transform", F.col("_d.transform")).withColumn(
        "basis", F.col("_d.basis")).drop("_d")
