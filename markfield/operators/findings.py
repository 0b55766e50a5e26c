"""Every problem in a dataset's rows, from one scan of its samples and one of its patches.

:func:`judged_samples` reads both tables once and leaves one narrow row a sample; problems, totals and the digest of the
samples come from that table. Its size is that of the sample names, not of the pixels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from markfield.config import Taxonomy


def row_digest(columns: Sequence[str]) -> Column:
    """A number of the row's text; added up, it does not depend on the order of rows or partitions."""
    text = F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("decimal(20,0)")


def digest_text(rows: DataFrame, number: str | Column) -> tuple[str, int]:
    """Digest and row count of a table from the numbers of its rows."""
    total = rows.select((F.col(number) if isinstance(number, str) else number).alias("n")).agg(
        F.sum("n").alias("s"), F.count(F.lit(1)).alias("c")).head()
    return f"{total.c}-{total.s or 0}", total.c


def judged_samples(samples: DataFrame, patches: DataFrame, size: int, taxonomy: Taxonomy, columns: Sequence[str]) -> DataFrame:
    """``path, fine_label, area, split, number, patch_good, label_known``, one row a sample.

    A patch is good if it is there once, holds size x size x 3 bytes and has the sample's digest. Pixels become a
    length and a digest before anything moves. Null and empty areas and splits are the same; repeated samples stay.
    """
    stored = patches.groupBy("patch_id").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(F.octet_length("pixels")).alias("_bytes"), F.min(F.sha2("pixels", 256)).alias("_actual"))
    told = samples.select("patch_id", "path", "sha256", "fine_label", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("area", "split")),
                          row_digest(columns).alias("number"))
    good = (F.col("_copies") == 1) & (F.col("_bytes") == 3 * size * size) & (F.col("_actual") == F.col("sha256"))
    return told.join(stored, "patch_id", "left").select(
        F.coalesce("path", F.lit("")).alias("path"), "fine_label", "area", "split", "number", F.coalesce(good, F.lit(False)).alias("patch_good"),
        F.coalesce(F.col("fine_label").isin(*taxonomy.fine_labels), F.lit(False)).alias("label_known"))


def problem(check: str, text: str, detail: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.concat(F.lit(text), F.coalesce(detail, F.lit("null"))).alias("detail"))


def sample_problems(judged: DataFrame) -> DataFrame:
    """``check, place, detail`` of every sample with a bad patch or an unknown label; the place is its path."""
    found = F.array_compact(F.array(F.when(~F.col("patch_good"), problem("patches", "bad patch ", F.col("path"))),
                                    F.when(~F.col("label_known"), problem("labels", "unknown label ", F.col("fine_label")))))
    return judged.select(F.col("path").alias("place"), F.explode(found).alias("p")).select("p.check", "place", "p.detail")


def area_problems(judged: DataFrame) -> DataFrame:
    """``check, place, detail`` of every area in more than one split: its first and last split, and their number above two."""
    splits = judged.select("area", "split").distinct().groupBy("area").agg(
        F.min("split").alias("first"), F.max("split").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    more = F.when(F.col("n") > 2, F.format_string(" of %d", "n")).otherwise(F.lit(""))
    return splits.select(F.lit("splits").alias("check"), F.col("area").alias("place"),
                         F.concat("area", F.lit(" ("), "first", F.lit(", "), "last", more, F.lit(")")).alias("detail"))


def first_problems(problems: DataFrame, most: int) -> DataFrame:
    """``check, rank, problems, detail``: the first ``most`` problems of each check by place, and how many there are.

    The rank limit is applied before the shuffle, so a check that every row fails moves ``most`` rows a task.
    """
    order = W.partitionBy("check").orderBy("place", "detail")
    ranked = problems.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    # One row a check.
    counted = F.broadcast(problems.groupBy("check").agg(F.count(F.lit(1)).alias("problems")))
    return ranked.join(counted, "check").select("check", "rank", "problems", "detail")
