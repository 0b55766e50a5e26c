"""Row-wise comparison of a raster with its twin and the resulting pixel source.

A raster is a set of rows ``image, row_no, px``; candidate rows also carry ``height``, so
that flipping a row number needs no join. Joins of rows ask for a merge: rows are read
from a few file names, so Spark would take them for small and broadcast them. Rasters are compared by a tree of
digests, which are made in one reading for all four transforms; pixels themselves only travel for rows that are known
to differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.config import TRANSFORMS, Settings
from markfield.functions.pixels import (
    count_differences,
    differing_columns,
    mirror_row,
    row_products,
    strided_grey,
)
from markfield.operators.skew import row_partitions, running_total, settle


def flip_rows(rows: DataFrame, name: Column, height: Column) -> DataFrame:
    """Rows of the raster after the transform in column ``name`` (null = identity)."""
    upside = name.isin("vflip", "rot180")
    mirrored = name.isin("hflip", "rot180")
    return rows.select(
        *[c for c in rows.columns if c not in ("row_no", "px")],
        F.when(upside, height - 1 - F.col("row_no")).otherwise(F.col("row_no")).cast("int").alias("row_no"),
        F.when(mirrored, mirror_row("px")).otherwise(F.col("px")).alias("px"))


#: Scan lines of a block of the digest tree.
BLOCK_ROWS = 256


def leaf_digests(reference: DataFrame, candidate: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Digests of all scan lines in the shared folder: ``image, row_no, digest`` and ``image, row_no, height, plain, mirrored``.

    Decoding is the costly part, and every level of the tree starts from these.
    """
    def digest(px: Column | str) -> Column:
        # 128 bits of the digest, as a node has: they make up most of what is written and shuffled.
        return F.substring(F.unhex(F.sha2(px, 256)), 1, 16)

    own = reference.select("image", F.col("row_no").cast("int").alias("row_no"), digest("px").alias("digest"))
    other = candidate.select("image", F.col("row_no").cast("int").alias("row_no"), "height", digest("px").alias("plain"),
                             digest(mirror_row("px")).alias("mirrored"))
    return settle(own, "own_lines"), settle(other, "twin_lines")


def _node(digest: Column | str, row_no: Column) -> list[Column]:
    """Two columns that add up, by exclusive or, to the digest of any set of numbered lines."""
    return [F.bit_xor(F.xxhash64(F.lit(part), row_no, digest)) for part in (1, 2)]


def _own_nodes(own: DataFrame, *by: Column) -> DataFrame:
    return own.groupBy("image", *by).agg(F.array(*_node("digest", F.col("row_no"))).alias("own"), F.count(F.lit(1)).alias("rows"))


def _turned() -> dict[str, tuple[Column, Column]]:
    """Place and digest of a twin's line under each transform."""
    row, upside = F.col("row_no").cast("int"), (F.col("height") - 1 - F.col("row_no")).cast("int")
    plain, mirrored = F.col("plain"), F.col("mirrored")
    return {"identity": (row, plain), "hflip": (row, mirrored), "vflip": (upside, plain), "rot180": (upside, mirrored)}


def _whole_twins(other: DataFrame) -> DataFrame:
    """``image, transform, twin``: digests of whole twins under each transform, combined in one pass without more rows."""
    whole = other.groupBy("image").agg(*[F.array(*_node(digest, row)).alias(name) for name, (row, digest) in _turned().items()])
    return whole.select("image", F.explode(F.array(*[F.struct(F.lit(name).alias("transform"), F.col(name).alias("twin"))
                                                     for name in TRANSFORMS])).alias("_n")).select("image", "_n.*")


def _twin_lines(other: DataFrame) -> DataFrame:
    """``image, row_no, transform, digest``: every line of the twin at its place under each transform."""
    at = F.explode(F.array(*[F.struct(F.lit(name).alias("transform"), row.alias("row_no"), digest.alias("digest"))
                             for name, (row, digest) in _turned().items()]))
    return other.select("image", at.alias("_at")).select("image", "_at.transform", "_at.row_no", "_at.digest")


def _twin_nodes(other: DataFrame, *by: Column) -> DataFrame:
    return _twin_lines(other).groupBy("image", "transform", *by).agg(F.array(*_node("digest", F.col("row_no"))).alias("twin"))


def _alike_lines(own: DataFrame, other: DataFrame, opened: DataFrame, block: Column) -> DataFrame:
    """``image, transform, block, n``: equal lines of the opened blocks ``image, transform, block, rows``.

    A line of the twin travels to its two places with both digests and one join counts for all transforms. Where most
    lines are open, none are left out before it: that would shuffle all of them once more.
    """
    row, upside = F.col("row_no"), (F.col("height") - 1 - F.col("row_no")).cast("int")
    at = F.explode(F.array(F.struct(row.alias("row_no"), F.lit(False).alias("upside")), F.struct(upside.alias("row_no"), F.lit(True).alias("upside"))))
    met = other.select("image", at.alias("_at"), "plain", "mirrored").select("image", "_at.row_no", "_at.upside", "plain", "mirrored")
    places = opened.groupBy("image", "block").agg(F.max("rows").alias("rows"))
    number = own.count()
    if 2 * (places.agg(F.sum("rows")).head()[0] or 0) < number:
        places = places.drop("rows")
        own, met = (side.withColumn("block", block).join(places, ["image", "block"], "left_semi").drop("block") for side in (own, met))
    tasks = row_partitions(own.sparkSession, 3 * number)
    keys = ["image", "row_no"]
    pairs = own.repartition(tasks, *keys).join(met.repartition(tasks, *keys).hint("merge"), keys)
    same = {"identity": ~F.col("upside") & (F.col("digest") == F.col("plain")), "hflip": ~F.col("upside") & (F.col("digest") == F.col("mirrored")),
            "vflip": F.col("upside") & (F.col("digest") == F.col("plain")), "rot180": F.col("upside") & (F.col("digest") == F.col("mirrored"))}
    found = pairs.groupBy("image", block).agg(*[F.count_if(same[name]).alias(name) for name in TRANSFORMS])
    told = found.select("image", "block", F.explode(F.array(*[F.struct(F.lit(name).alias("transform"), F.col(name).alias("n")) for name in TRANSFORMS])).alias("_n"))
    told = told.select("image", "_n.transform", "block", "_n.n").filter("n > 0")
    return told.join(opened.select("image", "transform", "block").hint("merge"), ["image", "transform", "block"], "left_semi")


def row_agreement(reference: DataFrame, candidate: DataFrame, sizes: DataFrame, candidate_sizes: DataFrame, *,
                  until_equal: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Share of bit-identical rows per image and transform, 6 decimals.

    Every image of ``sizes`` that has a candidate gets four rows; images whose sizes
    differ get 0.0 for all four, images without rows on either side have no share and are left out. With ``until_equal`` the transforms after the first under which both are equal are left out.

    A tree of digests over scan lines, blocks of lines and whole rasters decides: equal rasters are settled by one
    pair of digests, of the others equal blocks count as a whole, and only lines of unlike blocks are compared. A
    node's digest is combined before the shuffle, so a raster costs one row a task, not one a line; upside down, a line
    counts for the block at its turned place.
    """
    both = sizes.join(candidate_sizes.select(
        "image", F.col("width").alias("c_width"), F.col("height").alias("c_height")), "image").filter("height > 0 AND c_height > 0")
    same_size = (F.col("width") == F.col("c_width")) & (F.col("height") == F.col("c_height"))
    names = F.explode(F.array(*map(F.lit, TRANSFORMS)))
    asked = both.select("image", "height", same_size.alias("same_size"), names.alias("transform"))
    own, other = leaf_digests(reference, candidate)
    whole = _own_nodes(own).drop("rows").join(_whole_twins(other).hint("merge"), "image").select(
        "image", "transform", (F.col("own") == F.col("twin")).alias("equal"))
    asked = settle(asked.join(whole, ["image", "transform"], "left").withColumn(
        "equal", F.col("same_size") & F.coalesce("equal", F.lit(False))), "raster_digests")
    if until_equal:
        first = asked.filter("equal").groupBy("image").agg(F.min(transform_rank(F.col("transform"))).alias("_first"))
        asked = asked.join(first, "image", "left").filter(
            F.col("_first").isNull() | (transform_rank(F.col("transform")) <= F.col("_first"))).drop("_first")
        asked = settle(asked, "raster_digests")
    # Blocks of rasters that are not equal, then lines of blocks that are not equal. A raster of one block is that block.
    unlike = asked.filter("same_size AND NOT equal").select("image", "transform", "height")
    tall = unlike.filter(F.col("height") > block_rows)
    images = tall.select("image").distinct()
    block = F.floor(F.col("row_no") / block_rows).alias("block")
    blocks = settle(_own_nodes(own.join(images, "image", "left_semi"), block).join(
        _twin_nodes(other.join(images, "image", "left_semi"), block).hint("merge"), ["image", "block"]).join(
        tall, ["image", "transform"], "left_semi").select(
        "image", "transform", "block", "rows", (F.col("own") == F.col("twin")).alias("equal")), "block_digests")
    opened = blocks.filter("NOT equal").select("image", "transform", "block", "rows").unionByName(unlike.filter(
        F.col("height") <= block_rows).select("image", "transform", F.lit(0).cast("bigint").alias("block"), F.col("height").alias("rows")))
    alike = _alike_lines(own, other, opened, block)
    counted = blocks.filter("equal").groupBy("image", "transform").agg(F.sum("rows").alias("n")).unionByName(
        alike.groupBy("image", "transform").agg(F.sum("n").alias("n"))).groupBy("image", "transform").agg(F.sum("n").alias("n"))
    rows = F.when(F.col("equal"), F.col("height")).otherwise(F.coalesce("n", F.lit(0)))
    share = F.bround(F.when(F.col("same_size"), rows / F.col("height")).otherwise(0.0), 6)
    return asked.join(counted, ["image", "transform"], "left").select("image", "transform", share.alias("agreement"), "same_size")


def transform_rank(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, TRANSFORMS)), name)


def best_transform(scores: DataFrame, score: str = "agreement") -> DataFrame:
    """Highest score per image, ties to the earlier transform, plus all scores as a map."""
    return scores.groupBy("image").agg(
        F.max_by("transform", F.struct(F.col(score), -transform_rank(F.col("transform")))).alias("best"),
        F.max(score).alias("best_score"),
        F.map_from_entries(F.collect_list(F.struct("transform", score))).alias("scores"))


def correlations(reference: DataFrame, candidate: DataFrame, stride: int = 8) -> DataFrame:
    """Pearson correlation of the strided grey rasters under each transform, 4 decimals.

    Only for rasters of equal size. Channel sums are integers, so the moments are exact
    and a constant raster gives exactly 0.0.
    """
    def small(rows: DataFrame, name: str, *more) -> DataFrame:
        return rows.filter(F.col("row_no") % stride == 0).select(
            "image", *more, F.floor(F.col("row_no") / stride).cast("int").alias("row"),
            strided_grey(F.col("px"), stride).alias(name))

    last = F.floor((F.col("height") - 1) / stride).cast("int")
    other = small(candidate, "b", last.alias("_last"))
    at = F.explode(F.array(F.struct(F.col("row").alias("row"), F.lit(False).alias("upside")),
                           F.struct((F.col("_last") - F.col("row")).alias("row"), F.lit(True).alias("upside"))))
    other = other.select("image", "b", at.alias("_at")).select("image", "b", "_at.row", "_at.upside")
    sums = small(reference, "a").join(other.hint("merge"), ["image", "row"]).select(
        "image", "upside", row_products("a", "b").alias("m"))
    moments = ["n", "a", "b", "aa", "bb", "ab", "ab_mirrored"]
    whole = sums.groupBy("image", "upside").agg(
        *[F.sum(F.col(f"m.{name}")).cast("decimal(19,0)").alias(name) for name in moments])
    var_a = F.col("n") * F.col("aa") - F.col("a") * F.col("a")
    var_b = F.col("n") * F.col("bb") - F.col("b") * F.col("b")

    def corr(product: str) -> Column:
        spread = F.sqrt(var_a.cast("double")) * F.sqrt(var_b.cast("double"))
        value = F.try_divide((F.col("n") * F.col(product) - F.col("a") * F.col("b")).cast("double"), spread)
        return F.when((var_a > 0) & (var_b > 0), F.bround(value, 4)).otherwise(0.0)

    names = F.when(F.col("upside"), F.array(F.lit("vflip"), F.lit("rot180"))).otherwise(
        F.array(F.lit("identity"), F.lit("hflip")))
    pairs = F.arrays_zip(names.alias("transform"), F.array(corr("ab"), corr("ab_mirrored")).alias("correlation"))
    return whole.select("image", F.explode(pairs).alias("_p")).select("image", "_p.transform", "_p.correlation")


def confident_relation(scores: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Winner when it is high enough and clearly ahead of the runner-up, else ``undetermined``."""
    # Four entries per image at most, the best first.
    entry = F.struct((-F.col("correlation")).alias("down"), transform_rank(F.col("transform")).alias("rank"), "transform", "correlation")
    ranked = scores.groupBy("image").agg(F.array_sort(F.collect_list(entry)).alias("best"))
    first, second = F.col("best")[0], F.try_element_at("best", F.lit(2))
    clear = (first["correlation"] >= settings.min_correlation) & (
        first["correlation"] - second["correlation"] >= settings.min_correlation_lead)
    return ranked.select(
        "image", F.when(clear, first["transform"]).otherwise("undetermined").alias("relation"),
        F.map_from_entries(F.transform("best", lambda e: F.struct(e["transform"], e["correlation"]))).alias("correlation"))


def choose_source(has_twin: Column, best: Column, best_score: Column, relation: Column,
                  settings: Settings = Settings()) -> Column:
    """``struct(jpeg_to_tiff, pixel_source, pixel_check)`` from the comparison evidence."""
    def outcome(link: Column, source: Column, check: Column) -> Column:
        return F.struct(link.alias("jpeg_to_tiff"), source.alias("pixel_source"), check.alias("pixel_check"))

    tiff = F.lit("tiff")
    return (
        F.when(~has_twin, outcome(F.lit("none"), tiff, F.lit("no_jpeg_pair_unverified")))
        .when(best_score == 1.0, outcome(best, tiff, F.concat(F.lit("tiff_bit_identical_to_jpeg_"), best)))
        .when(best_score >= settings.min_exact_rows,
              outcome(best, F.concat(F.lit("jpeg_"), best), F.lit("tiff_damaged_rebuilt_from_jpeg")))
        .otherwise(outcome(F.coalesce(relation, F.lit("undetermined")), tiff,
                           F.lit("tiff_not_an_exact_copy_of_jpeg_used_as_is")))
    )


def differing_rows(reference: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """``image, row_no, differing, white, a, b`` for rows whose bytes differ."""
    a = reference.select("image", "row_no", F.col("px").alias("a"))
    b = rebuilt.select("image", "row_no", F.col("px").alias("b"))
    rows = a.join(b.hint("merge"), ["image", "row_no"]).filter(F.col("a") != F.col("b"))
    return rows.withColumn("_d", count_differences("a", "b")).select(
        "image", "row_no", "_d.differing", "_d.white", "a", "b")


def difference_report(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Differing pixels, their fraction (8 decimals, NaN without pixels) and the pure white ones, per image."""
    totals = rows.groupBy("image").agg(F.sum("differing").alias("differing"), F.sum("white").alias("white"))
    area = F.col("width").cast("double") * F.col("height")
    fraction = F.when(area == 0, float("nan")).otherwise(F.bround(F.coalesce("differing", F.lit(0)) / area, 8))
    return sizes.join(totals, "image", "left").select(
        "image", F.coalesce("differing", F.lit(0)).alias("tiff_differing_pixels"),
        fraction.alias("tiff_differing_pixel_fraction"),
        F.coalesce("white", F.lit(0)).alias("tiff_differing_pixels_pure_white"))


def difference_count(rows: DataFrame) -> int:
    """Number of differing pixels, from the totals of their rows."""
    return int(rows.agg(F.sum("differing")).head()[0] or 0)


def difference_positions(rows: DataFrame, limit: int | None) -> DataFrame:
    """Centres of differing pixels, the first ``limit`` of an image in row-major order.

    The running total per row tells which rows can contribute before any pixel is
    expanded; ``limit=None`` gives every position.
    """
    source = rows
    if limit is not None:
        before = running_total(rows.select("image", "row_no", "differing"), ["image"], "row_no", "differing",
                               "_before").filter(F.col("_before") < limit)
        source = rows.select("image", "row_no", "a", "b").join(
            before.select("image", "row_no", "_before"), ["image", "row_no"])
    pixels = source.select("image", "row_no", *([] if limit is None else ["_before"]),
                           F.posexplode(differing_columns("a", "b")).alias("_pos", "_col"))
    if limit is not None:
        pixels = pixels.filter(F.col("_before") + F.col("_pos") < limit)
    return pixels.select("image", (F.col("_col") + 0.5).alias("x"), (F.col("row_no") + 0.5).alias("y"))
