"""First-wins de-duplication of files and points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from markfield.functions import geometry as G
from markfield.functions import names as N
from markfield.operators.skew import lookup_join


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], target: str,
               name: str = "duplicate_of") -> DataFrame:
    """Add ``name``: the ``target`` of the first row with the same keys, null on that row.

    Rows with a null key take no part. The winner comes from a map-side combined
    ``min(struct)`` and is looked up, so a group holding a third of all rows is never
    sorted or gathered in one task. ``target`` must identify a row.
    """
    keys = list(keys)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    ranked = F.struct(*[column.alias(f"o{i}") for i, column in enumerate(order)], F.col(target).alias("winner"))
    winners = rows.filter(known).groupBy(*keys).agg(F.min(ranked).alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = winners.filter(F.col("_n") > 1).select(*keys, F.col("_first.winner").alias("_winner"))
    joined = lookup_join(rows, repeated, keys, [target])
    return joined.withColumn(
        name, F.when(F.col("_winner") != F.col(target), F.col("_winner"))).drop("_winner")


def file_order(relpath: str = "relpath") -> list[Column]:
    """Scan order: files outside the export folder first, then by lower-case path."""
    path = F.col(relpath)
    return [N.in_set_folder(path), F.lower(path), path]


def content_duplicates(files: DataFrame, eligible: Column) -> DataFrame:
    """Same bytes among eligible files; all files are returned."""
    keyed = files.withColumn("_content", F.when(eligible, F.col("sha256")))
    return first_wins(keyed, ["_content"], file_order(), "relpath").drop("_content")


def coordinate_set_key(points: Column) -> Column:
    """Digest of the rounded point sequence of one file."""
    text = F.transform(points, lambda p: F.format_string(
        "%.4f,%.4f", G.coordinate_key(p["x"]), G.coordinate_key(p["y"])))
    return F.sha2(F.array_join(text, ";").cast("binary"), 256)


def coordinate_duplicates(files: DataFrame, eligible: Column) -> DataFrame:
    """Different bytes but the same image, label and point sequence.

    Preference: file name not contradicting the image number, outside the export
    folder, lower-case path. Needs ``image, fine_label, coordinate_key, relpath``.
    """
    order = [F.coalesce(~F.col("hint_matches_image"), F.lit(False)), *file_order()[:2], F.col("relpath")]
    keyed = files.withColumn("_coordinates", F.when(eligible, F.col("coordinate_key")))
    return first_wins(keyed, ["image", "fine_label", "_coordinates"], order, "relpath").drop("_coordinates")


def dedup_points(refs: DataFrame, order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One row per (image, label, 4-decimal location); the first occurrence keeps its values.

    ``refs`` holds one row per supplied point: ``image, fine_label, x, y``, the
    ``order`` columns and anything in ``carry``. Adds ``key_x, key_y, ref_count`` and
    ``point_id``. The supplied rows themselves, tagged by :func:`tag_points`, are the
    lineage; they stay rows because a location may be referenced without limit.
    """
    first = F.min(F.struct(*order, "x", "y", *carry)).alias("_first")
    unique = tag_points(refs).groupBy("image", "fine_label", "key_x", "key_y").agg(
        first, F.count(F.lit(1)).alias("ref_count"))
    picked = unique.select("image", "fine_label", "key_x", "key_y", "ref_count", "_first.*")
    return picked.withColumn("point_id", _point_id())


def tag_points(refs: DataFrame) -> DataFrame:
    """Location key of every supplied point (no shuffle)."""
    return refs.withColumn("key_x", G.coordinate_key(F.col("x"))).withColumn(
        "key_y", G.coordinate_key(F.col("y")))


def point_lineage(refs: DataFrame, order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """``point_id`` with every supplied point behind it, still one row each."""
    return tag_points(refs).select(_point_id().alias("point_id"), *order, *payload)


def _point_id() -> Column:
    return G.point_id(F.col("image"), F.col("fine_label"), F.col("key_x"), F.col("key_y"))


def labels_at_location(points: DataFrame) -> DataFrame:
    """Distinct labels at each rounded location.

    After :func:`dedup_points` a location holds at most one row per label, so this
    window never spans more rows than the taxonomy has labels.
    """
    here = W.partitionBy("image", "key_x", "key_y")
    return points.withColumn("labels_here", F.count(F.lit(1)).over(here))
