"""Counts, checks and preview tables over points, samples and files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from markfield.config import Taxonomy
from markfield.operators.skew import work_partitions


def split_counts(samples: DataFrame) -> DataFrame:
    """Rows per split, label and subtype; a blank subtype shows as ``-``."""
    subtype = F.coalesce(F.nullif(F.col("subtype"), F.lit("")), F.lit("-"))
    return samples.groupBy("split", "label", subtype.alias("subtype")).agg(F.count(F.lit(1)).alias("n"))


def nested_counts(samples: DataFrame) -> DataFrame:
    """One row: split -> label -> subtype -> count with sorted keys.

    The groups gathered here are bounded by the splits and the taxonomy.
    """
    def to_map(key: str, value: str):
        return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))

    by_label = split_counts(samples).groupBy("split", "label").agg(to_map("subtype", "n").alias("subtypes"))
    by_split = by_label.groupBy("split").agg(to_entries("label", "subtypes").alias("labels"))
    return by_split.agg(to_entries("split", "labels").alias("counts"))


def to_entries(key: str, value: str):
    """Sorted map from a bounded group whose values are maps (which do not order)."""
    pairs = F.collect_list(F.struct(F.col(key).alias("key"), F.col(value).alias("value")))
    ordered = F.array_sort(pairs, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.map_from_entries(ordered)


def totals(samples: DataFrame, column: str = "fine_label") -> DataFrame:
    return samples.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def rare_labels(samples: DataFrame, taxonomy: Taxonomy, below: int = 300) -> DataFrame:
    """Labels with fewer samples than ``below``, including labels with none."""
    names = F.explode(F.array(*map(F.lit, taxonomy.fine_labels)))
    labels = samples.sparkSession.range(1).select(names.alias("fine_label"))
    counted = labels.join(totals(samples), "fine_label", "left")
    return counted.select("fine_label", F.coalesce("n", F.lit(0)).alias("n")).filter(F.col("n") < below)


def excluded_points(points: DataFrame) -> DataFrame:
    return points.filter(F.col("status") != "included").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def supplied_points(files: DataFrame) -> DataFrame:
    """Points in used files by label, before any point is merged."""
    return files.filter(F.col("status") == "used").groupBy("fine_label").agg(
        F.sum(F.coalesce("point_count", F.lit(0))).cast("bigint").alias("points"))


def duplicate_refs(points: DataFrame) -> DataFrame:
    return points.agg(F.coalesce(F.sum(F.col("ref_count") - 1), F.lit(0)).cast("bigint").alias("duplicate_point_refs"))


def files_per_point(lineage: DataFrame) -> DataFrame:
    """Distinct annotation files behind each point (two combined steps, no list)."""
    return lineage.select("point_id", "roi").distinct().groupBy("point_id").agg(F.count(F.lit(1)).alias("roi_files"))


def excluded_files(files: DataFrame) -> DataFrame:
    return files.filter(F.col("status") == "excluded").select(
        "relpath", "reason", "duplicate_of", "point_count", F.col("fine_label").alias("label"))


def image_totals(points: DataFrame) -> DataFrame:
    return points.groupBy("image").agg(F.count_if(F.col("status") == "included").alias("included"),
                                       F.count(F.lit(1)).alias("unique_points"))


def leaking_areas(samples: DataFrame) -> DataFrame:
    """Areas that occur in more than one split."""
    splits = F.sort_array(F.collect_set("split"))
    return samples.groupBy("area").agg(splits.alias("splits")).filter(F.size("splits") > 1)


def unknown_labels(samples: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    return samples.filter(F.col("fine_label").isNull() | ~F.col("fine_label").isin(*taxonomy.fine_labels))


def hash_mismatches(recorded: DataFrame, actual: DataFrame) -> DataFrame:
    """Recorded files that are missing or whose digest changed."""
    found = recorded.join(actual.select("relpath", F.col("sha256").alias("actual")), "relpath", "left")
    return found.filter(F.col("actual").isNull() | (F.col("actual") != F.col("sha256"))).select(
        "relpath", "sha256", "actual")


def sample_per_label(samples: DataFrame, key: str, count: int) -> DataFrame:
    """Repeatable choice of ``count`` rows per label, by digest of the key."""
    order = W.partitionBy("fine_label").orderBy(F.sha2(F.col(key).cast("string"), 256), key)
    return samples.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mean_patch(patches: DataFrame, label: str = "fine_label", pixels: str = "pixels") -> DataFrame:
    """``label, pos, mean``: element-wise mean of all patches of a label.

    Each task adds its patches up first and sends one total per label and element; the
    number of tasks is bounded so that these totals stay small next to the patches.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        counts: dict[str, int] = {}
        for batch in batches:
            for name, group in batch.groupby(label):
                block = np.frombuffer(b"".join(group[pixels]), np.uint8).reshape(len(group), -1)
                total = block.sum(axis=0, dtype=np.int64)
                sums[name] = sums[name] + total if name in sums else total
                counts[name] = counts.get(name, 0) + len(group)
        for name, total in sums.items():
            yield pd.DataFrame({label: name, "pos": np.arange(len(total), dtype=np.int32),
                                "total": total, "n": np.int64(counts[name])})

    rows = patches.select(F.col(label).cast("string").alias(label), pixels).coalesce(
        work_partitions(patches.sparkSession))
    parts = rows.mapInPandas(
        partial, f"{label} string, pos int, total bigint, n bigint")
    return parts.groupBy(label, "pos").agg((F.sum("total") / F.sum("n")).alias("mean"))


def stretch(means: DataFrame, label: str = "fine_label") -> DataFrame:
    """Mean patch scaled so that its 1 % and 99 % points become 0 and 255 (truncated)."""
    bounds = means.groupBy(label).agg(F.percentile("mean", F.array(F.lit(0.01), F.lit(0.99))).alias("_b"))
    low, high = F.col("_b")[0], F.col("_b")[1]
    value = (F.col("mean") - low) * 255.0 / F.greatest(high - low, F.lit(1e-6))
    return means.join(bounds, label).select(
        label, "pos", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), value))).cast("int").alias("value"))
