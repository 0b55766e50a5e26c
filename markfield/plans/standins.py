"""Inputs for the registered queries, derived from the given tables.

The tables hold no rasters or annotation files, so Spark derives them: annotation
files with real encoded bytes from ``orders``, raster folders from ``supplier``, points
from ``events`` and rasters from the whole bytes of ``documents``. Expressions marked
shared are valid in Spark and in ANSI SQL engines alike and are also used by the
reference SQL in ``oracle.py``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markfield.operators.agreement import flip_rows

WIDTH = 32
LINE = 3 * WIDTH
PATCH = 8
#: How far some points are moved away from their rasters, in pixels.
FAR = 10_000.0
RADIUS = 1
SHIFTS = ((4, 0), (0, 4), (-4, 0), (0, -4), (3, 3), (-3, -3), (3, -3), (-3, 3))

# Shared: name -> expression over `orders`.
ANNOTATION_FILES = {
    "file_id": "o_orderkey",
    "relpath": (
        "concat(CASE WHEN o_orderkey % 23 = 0 THEN 'misc' ELSE concat(CAST(o_custkey % 10 AS STRING), ' Area') END, '/',"
        " CASE WHEN o_orderkey % 2 = 0 THEN 'before' ELSE 'after' END, ' annealing_', CAST(o_custkey % 3 AS STRING),"
        " CASE WHEN o_custkey % 17 = 0 THEN '_X100' ELSE '' END, '/',"
        " CASE WHEN o_orderkey % 7 = 0 THEN 'RoiSet/' WHEN o_orderkey % 7 = 1 THEN 'roiset/' ELSE '' END,"
        " CASE WHEN o_orderkey % 13 = 0 THEN 'scan' WHEN o_orderkey % 2 = 0 THEN 'Before' ELSE 'After' END,"
        " ' an_', CASE WHEN o_orderkey % 5 = 0 THEN 'area ' ELSE '' END, CAST(o_custkey % 10 AS STRING), '_',"
        " CAST(o_custkey % 5 AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN '-1_' ELSE '_' END,"
        " CASE o_orderkey % 13 WHEN 0 THEN 'BPD' WHEN 1 THEN 'TED(a)' WHEN 2 THEN 'TED (F)' WHEN 3 THEN 'ted(c)'"
        " WHEN 4 THEN 'TSD(b)' WHEN 5 THEN 'TSD( C )' WHEN 6 THEN 'TED' WHEN 7 THEN 'TSD(e)' WHEN 8 THEN 'BPD(a)'"
        " WHEN 9 THEN 'unknown' WHEN 10 THEN 'BPD_TED(a)' WHEN 11 THEN 'TEDx(a)' ELSE 'TED(a) TED' END,"
        " '_', CAST(o_orderkey AS STRING), '.roi')"
    ),
    "custkey": "o_custkey",
    "points_wanted": "1 + o_custkey % 4",
    "subpixel_wanted": "o_custkey % 2 = 0",
    "variant": "o_orderkey % 3",
    "kind": ("CASE WHEN o_orderkey % 29 = 0 THEN 'empty' WHEN o_orderkey % 29 = 1 THEN 'garbage' "
             "WHEN o_orderkey % 29 = 2 THEN 'polygon' WHEN o_orderkey % 29 = 3 THEN 'page' ELSE 'point' END"),
}

# Shared: name -> expression over `supplier`.
RASTER_FILES = {
    "relpath": (
        "concat(CAST(s_suppkey % 10 AS STRING), ' Area/', CASE WHEN s_suppkey % 4 < 2 THEN 'before' ELSE 'after' END,"
        " ' annealing_', CAST(s_suppkey % 3 AS STRING), '/',"
        " CASE WHEN s_suppkey % 7 = 3 THEN 'scan' WHEN (s_suppkey % 4 < 2) = (s_suppkey % 7 < 5) THEN 'before annealing'"
        " ELSE 'after annealing' END, '_', CAST(s_suppkey % 5 AS STRING), '_', CAST(s_suppkey AS STRING),"
        " CASE WHEN s_suppkey % 11 < 3 THEN '.jpg' WHEN s_suppkey % 11 = 4 THEN '.TIFF' WHEN s_suppkey % 11 = 5"
        " THEN '.JPEG' ELSE '.tif' END)"
    ),
    "bytes": "s_suppkey * 1000",
}

# Shared: name -> expression over `events`.
POINTS = {
    "image": "CAST(user_id AS STRING)",
    "point_id": "CAST(event_id AS STRING)",
    "fine_label": "event_type",
    "x": "value",
    "y": "CAST((event_id * 37) % 1000 AS DOUBLE) + 0.5",
}
# Shared: name -> expression over `lineitem`: one image whose points crowd into the area of one cell.
DENSE_POINTS = {
    "image": "'0'",
    "point_id": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "fine_label": "l_returnflag",
    "x": "CAST((l_orderkey * 7919 + l_partkey * 31) % 64 AS DOUBLE) + 0.5",
    "y": "CAST((l_partkey * 104729 + l_suppkey * 17 + l_orderkey) % 128 AS DOUBLE) / 2",
}
COARSE_POINTS = {
    "image": "CAST(user_id AS STRING)",
    "fine_label": "event_type",
    "area": "CAST(user_id % 50 AS STRING)",
    "file_no": "CAST(event_id % 13 AS BIGINT)",
    "index": "event_id",
    "roi": "concat('r', CAST(event_id % 13 AS STRING))",
    "x": "floor(value / 16) * 16 + CAST(event_id % 2 AS DOUBLE) * 0.03125",
    "y": "CAST((event_id * 37) % 20 AS DOUBLE) * 10 + 0.5",
}
COARSE_WIDTH, COARSE_HEIGHT = 300, 190

# Shared: name -> expression over `events`, placed on the document rasters.
RASTER_POINTS = {
    "point_no": "event_id",
    "image": "CAST(CAST(floor(event_id / 10) AS BIGINT) AS STRING)",
    "fine_label": "event_type",
    "x": "CAST((event_id * 37) % 32 AS DOUBLE) + 0.5",
    "row_seed": "event_id * 101 + CAST(floor(value) AS BIGINT)",
}

# Shared: name -> expression over `events`, whole pixels of the document rasters below a folder per raster.
TREE_POINTS = {
    "event_id": "event_id",
    "image_no": "CAST(floor(event_id / 10) AS BIGINT)",
    "token": ("CASE event_type WHEN 'click' THEN 'BPD' WHEN 'view' THEN 'TED(a)' WHEN 'purchase' THEN 'TED(f)' "
              "WHEN 'signup' THEN 'TSD(b)' ELSE 'TSD(c)' END"),
    "fine_label": ("CASE event_type WHEN 'click' THEN 'BPD' WHEN 'view' THEN 'TED_a' WHEN 'purchase' THEN 'TED_f' "
                   "WHEN 'signup' THEN 'TSD_b' ELSE 'TSD_c' END"),
    "px": "CAST((event_id * 37) % 32 AS BIGINT)",
    "row_seed": "CAST(event_id * 101 + CAST(floor(value) AS BIGINT) AS BIGINT)",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Give a table stored in fewer splits than there are cores to all cores; larger ones stay as read."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def shared(rows: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return rows.selectExpr(*[f"{text} AS {name}" for name, text in expressions.items()])


def _hex(value: Column, digits: int) -> Column:
    mask = (1 << (4 * digits)) - 1
    return F.lpad(F.hex(value.cast("bigint").bitwiseAND(F.lit(mask).cast("bigint"))), digits, "0")


def _float_hex(value: Column) -> Column:
    """IEEE single of a value of at least one whose fraction fits, as hex digits."""
    power = F.floor(F.log2(value))
    fraction = (value / F.pow(F.lit(2.0), power) - 1) * F.lit(float(1 << 23))
    return _hex((power + 127) * F.lit(1 << 23) + fraction.cast("bigint"), 8)


def annotation_bytes(spark: SparkSession, sf: str) -> DataFrame:
    """``relpath, bytes, content`` plus the shared columns; content is a real point file."""
    files = shared(spread(table(spark, sf, "orders")), ANNOTATION_FILES)
    key, steps = F.col("custkey"), F.sequence(F.lit(0).cast("bigint"), F.col("points_wanted") - 1)
    xs = F.transform(steps, lambda i: (key * 7 + i * 13) % 400 + 10)
    ys = F.transform(steps, lambda i: (key * 11 + i * 29) % 180 + 10)

    def joined(values: Column, encode) -> Column:
        return F.array_join(F.transform(values, encode), "")

    head = F.concat(
        F.lit("496F757400E3"), F.when(F.col("kind") == "polygon", "0000").otherwise("0A00"),
        F.lit("0005000300000000"), _hex(F.col("points_wanted"), 4), F.lit("00" * 32),
        F.when(F.col("subpixel_wanted"), "0080").otherwise("0000"), F.lit("00" * 4),
        F.when(F.col("kind") == "page", "00000002").otherwise("00000000"), F.lit("00" * 4))
    whole = F.concat(joined(xs, lambda v: _hex(v - 3, 4)), joined(ys, lambda v: _hex(v - 5, 4)))
    exact = F.concat(joined(xs, lambda v: _float_hex(v + F.lit(0.25))), joined(ys, lambda v: _float_hex(v + F.lit(0.75))))
    body = F.concat(head, whole, F.when(F.col("subpixel_wanted"), exact).otherwise(""), _hex(F.col("variant"), 2))
    content = F.when(F.col("kind") == "empty", "").when(F.col("kind") == "garbage", "41" * 80).otherwise(body)
    return files.withColumn("content", F.unhex(content)).withColumn("bytes", F.octet_length("content").cast("bigint"))


def raster_files(spark: SparkSession, sf: str) -> DataFrame:
    return shared(table(spark, sf, "supplier"), RASTER_FILES)


def points(spark: SparkSession, sf: str) -> DataFrame:
    return shared(table(spark, sf, "events"), POINTS)


def dense_points(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct places of ``lineitem`` rows, all in one cell's area."""
    return shared(table(spark, sf, "lineitem"), DENSE_POINTS).dropDuplicates(["point_id"])


def coarse_refs(spark: SparkSession, sf: str) -> DataFrame:
    return shared(table(spark, sf, "events"), COARSE_POINTS)


def document_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a raster: 32 RGB pixels per row, the last row padded with zeros; a text without bytes has no rows."""
    text = spread(table(spark, sf, "documents").select("doc_id", "source", "text")).select("doc_id", "source", F.encode("text", "UTF-8").alias("data"))
    # Numbers from 0 to -1 would count down.
    text = text.filter(F.octet_length("data") > 0)
    height = F.ceil(F.octet_length("data") / LINE).cast("int")
    rows = text.select("doc_id", "source", "data", height.alias("height"),
                       F.explode(F.sequence(F.lit(0), height - 1)).alias("row_no"))
    part = F.substring("data", F.col("row_no") * LINE + 1, F.lit(LINE))
    return rows.select("doc_id", "source", F.col("doc_id").cast("string").alias("image"), "height", "row_no",
                       F.rpad(part, F.lit(LINE), F.lit(b"\x00")).alias("px"))


def tiff_rows(rows: DataFrame) -> DataFrame:
    """The raster to check: intact, with damaged rows, slightly changed or blank, by document."""
    kind, row = F.col("doc_id") % 6, F.col("row_no")
    hit = kind.isin(1, 4) & ((row * 7 + F.col("doc_id")) % 10 < 3)
    marked = F.concat(F.lit(b"\xff" * 30), F.substring("px", 31, LINE))
    px = (F.when(hit & (row % 2 == 0), marked).when(hit, F.lit(b"\x00" * LINE))
          .when(kind == 2, F.concat(F.substring("px", 1, LINE - 1), F.lit(b"\x07")))
          .when(kind == 5, F.lit(b"A" * LINE)).otherwise(F.col("px")))
    return rows.select("doc_id", "image", "height", "row_no", px.alias("px"))


@F.arrow_udf(T.BinaryType())
def _checked_pixels(doc_ids: pa.Array, texts: pa.Array) -> pa.Array:
    """All scan lines of :func:`tiff_rows` of whole documents, one cell each."""
    whole = texts.cast(pa.large_binary())
    starts = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset:whole.offset + len(whole) + 1]
    data, sizes = np.frombuffer(whole.buffers()[2] or b"", np.uint8), np.diff(starts)
    ends = np.concatenate([[0], np.cumsum(-(-sizes // LINE) * LINE)])
    # One buffer for the batch, filled in place.
    found = np.zeros(ends[-1], np.uint8)
    for n, doc_id in enumerate(doc_ids.to_numpy(zero_copy_only=False).tolist()):
        found[ends[n]:ends[n] + sizes[n]] = data[starts[n]:starts[n + 1]]
        px, kind = found[ends[n]:ends[n + 1]].reshape(-1, LINE), math.fmod(doc_id, 6)
        if kind == 2:
            px[:, -1] = 7
        elif kind == 5:
            px[:] = ord("A")
        elif kind in (1, 4):
            row = np.arange(len(px))
            hit = np.fmod(row * 7 + doc_id, 10) < 3
            px[hit & (row % 2 == 0), :30] = 255
            px[hit & (row % 2 == 1)] = 0
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(found)])


def tiff_files(spark: SparkSession, sf: str) -> DataFrame:
    """``doc_id, relpath, content``: every checked raster as an uncompressed big-endian TIFF of one strip.

    A raster is one document's text, so each is made where its document is read: no row of it is exploded or shuffled.
    """
    def entry(tag: int, kind: int, count: int, value: Column) -> Column:
        return F.concat(F.lit(f"{tag:04X}{kind:04X}{count:08X}"), value)

    text = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.encode("text", "UTF-8").alias("data")).filter("data IS NOT NULL")
    image = text.select("doc_id", F.ceil(F.octet_length("data") / LINE).cast("int").alias("height"), _checked_pixels("doc_id", "data").alias("pixels"))
    height, size, short = _hex(F.col("height"), 8), F.col("height") * LINE, lambda value: F.lit(f"{value:04X}0000")
    # Tags, types and order of the public TIFF 6.0 format.
    entries = [entry(256, 4, 1, F.lit(f"{WIDTH:08X}")), entry(257, 4, 1, height), entry(258, 3, 3, _hex(size + 8, 8)),
               entry(259, 3, 1, short(1)), entry(262, 3, 1, short(2)), entry(273, 4, 1, F.lit("00000008")),
               entry(277, 3, 1, short(3)), entry(278, 4, 1, height), entry(279, 4, 1, _hex(size, 8)), entry(284, 3, 1, short(1))]
    head = F.concat(F.lit("4D4D002A"), _hex(size + 14, 8))
    tail = F.concat(F.lit("000800080008"), F.lit(f"{len(entries):04X}"), *entries, F.lit("00000000"))
    return image.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".tif")).alias("relpath"),
                        F.concat(F.unhex(head), F.col("pixels"), F.unhex(tail)).alias("content"))


def twin_rows(rows: DataFrame) -> DataFrame:
    """The other copy: transformed by document, sometimes absent or one row short."""
    present = (F.col("source") != "src3") & ~((F.col("doc_id") % 13 == 0) & (F.col("height") > 1)
                                              & (F.col("row_no") == F.col("height") - 1))
    kept = rows.filter(present).withColumn("t", F.element_at(
        F.array(*map(F.lit, ("identity", "hflip", "vflip", "rot180"))), (F.col("doc_id") % 4 + 1).cast("int")))
    short = (F.col("doc_id") % 13 == 0) & (F.col("height") > 1)
    kept = kept.withColumn("c_height", F.when(short, F.col("height") - 1).otherwise(F.col("height")))
    return flip_rows(kept.drop("height"), F.col("t"), F.col("c_height")).select(
        "image", "row_no", F.col("c_height").alias("height"), "px")


def document_sizes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """``image, width, height`` of the checked rasters and of their twins."""
    text = table(spark, sf, "documents").select(
        "doc_id", "source", F.ceil(F.octet_length(F.encode("text", "UTF-8")) / LINE).cast("int").alias("height"))
    image, width = F.col("doc_id").cast("string").alias("image"), F.lit(WIDTH).alias("width")
    short = (F.col("doc_id") % 13 == 0) & (F.col("height") > 1)
    own = text.select(image, width, "height")
    twin = text.filter(F.col("source") != "src3").select(
        image, width, F.when(short, F.col("height") - 1).otherwise(F.col("height")).alias("height"))
    return own, twin


def raster_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points on the document rasters: ``point_no, image, fine_label, x, y, width, height``; ``y`` is null on a raster without rows."""
    sizes = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("image"),
        F.ceil(F.octet_length(F.encode("text", "UTF-8")) / LINE).cast("bigint").alias("height"))
    placed = shared(table(spark, sf, "events"), RASTER_POINTS).join(sizes, "image")
    return placed.select("point_no", "image", "fine_label", "x",
                         (F.try_mod("row_seed", "height").cast("double") + 0.25).alias("y"),
                         F.lit(WIDTH).cast("bigint").alias("width"), "height")


def tree_files(spark: SparkSession, sf: str) -> DataFrame:
    """``relpath, content`` of a whole source tree: a folder per document with its raster and a point file per label."""
    folder = F.concat((F.col("image_no") % 10).cast("string"), F.lit(" Area/before "), F.col("image_no").cast("string"), F.lit("/"))
    rasters = tiff_files(spark, sf).withColumnRenamed("doc_id", "image_no")
    sizes = table(spark, sf, "documents").select(
        F.col("doc_id").alias("image_no"), F.ceil(F.octet_length(F.encode("text", "UTF-8")) / LINE).cast("bigint").alias("height"))
    # A point of a raster without rows is told at row 0, which lies outside it.
    row = F.coalesce(F.try_mod("row_seed", "height"), F.lit(0))
    placed = shared(table(spark, sf, "events"), TREE_POINTS).join(sizes, "image_no").withColumn("py", row)
    # A raster has ten points.
    files = placed.groupBy("image_no", "token").agg(F.array_sort(F.collect_list(F.struct("event_id", "px", "py"))).alias("told"))
    head = F.concat(F.lit("496F757400E30A00" + "00" * 8), _hex(F.size("told"), 4), F.lit("00" * 46))
    axis = [F.array_join(F.transform("told", _coordinate(name)), "") for name in ("px", "py")]
    name = F.concat(folder, F.lit("before "), F.col("image_no").cast("string"), F.lit(" "), F.col("token"), F.lit(".roi"))
    annotations = files.select(name.alias("relpath"), F.unhex(F.concat(head, *axis, F.hex(F.encode(name, "UTF-8")))).alias("content"))
    return annotations.unionByName(rasters.select(F.concat(folder, "relpath").alias("relpath"), "content"))


def _coordinate(name: str):
    def encoded(place: Column) -> Column:
        return _hex(place[name], 4)
    return encoded
