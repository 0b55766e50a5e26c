"""Rasters as rows of scan lines.

Uncompressed TIFFs are cut into row chunks that are read in parallel straight from
their file offsets. Everything else (JPEG, compressed TIFF) goes through Spark's image
source, which decodes one file per task.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from markfield.functions.pixels import swap_red_blue
from markfield.operators.skew import work_partitions
from markfield.sources.files import MEMBER, dealt, open_file, relative_to, qualified, stream_sha256

#: Boxes handled at once, and cells of a summed-area table.
RUN, TABLE_CELLS = 2_048, 2_000_000
CHUNK_BYTES = 16 << 20
ROWS = "image string, row_no int, height int, px binary"

# Fixed values of the public TIFF 6.0 / BigTIFF format.
TIFF_TAGS = {256: "width", 257: "height", 258: "bits", 259: "compression", 262: "photometric", 273: "offsets",
             277: "samples", 278: "rows_per_strip", 279: "counts", 284: "planar", 322: "tile_width", 339: "format"}
TIFF_TYPES = {1: "B", 3: "H", 4: "I", 13: "I", 16: "Q"}
COMPRESSIONS = {1: "NONE", 5: "LZW", 7: "JPEG", 8: "ADOBE_DEFLATE", 32773: "PACKBITS", 32946: "DEFLATE"}
PHOTOMETRICS = {0: "MINISWHITE", 1: "MINISBLACK", 2: "RGB", 3: "PALETTE", 5: "SEPARATED", 6: "YCBCR"}

HEADER = ("relpath string, path string, bytes bigint, sha256 string, width int, height int, bits int, samples int, "
          "compression string, photometric string, pages int, strips boolean, rows_per_strip bigint, "
          "offsets array<bigint>, problem string")


def _tiff_directory(stream) -> tuple[dict, int]:
    """Known tags of the first page and the offset of the next page."""
    start = stream.read(16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    magic = struct.unpack_from(order + "H", start, 2)[0] if order and len(start) >= 8 else 0
    if magic not in (42, 43):
        raise ValueError("not_a_tiff")
    big = magic == 43
    offset = struct.unpack_from(order + ("Q" if big else "I"), start, 8 if big else 4)[0]
    stream.seek(offset)
    count_size, entry_size, link_size = (8, 20, 8) if big else (2, 12, 4)
    count = struct.unpack(order + ("Q" if big else "H"), stream.read(count_size))[0]
    body = stream.read(count * entry_size + link_size)
    tags = {}
    for index in range(count):
        tag, kind = struct.unpack_from(order + "HH", body, index * entry_size)
        if tag not in TIFF_TAGS or kind not in TIFF_TYPES:
            continue
        amount = struct.unpack_from(order + ("Q" if big else "I"), body, index * entry_size + 4)[0]
        layout = f"{order}{amount}{TIFF_TYPES[kind]}"
        at, room = index * entry_size + (12 if big else 8), 8 if big else 4
        if struct.calcsize(layout) <= room:
            values = struct.unpack_from(layout, body, at)
        else:
            stream.seek(struct.unpack_from(order + ("Q" if big else "I"), body, at)[0])
            values = struct.unpack(layout, stream.read(struct.calcsize(layout)))
        tags[TIFF_TAGS[tag]] = list(values)
    return tags, struct.unpack_from(order + ("Q" if big else "I"), body, count * entry_size)[0]


def _header(relpath: str, path: str, size: int) -> dict:
    record = {"relpath": relpath, "path": path, "bytes": size, "sha256": stream_sha256(path)}
    try:
        with open_file(path) as stream:
            tags, following = _tiff_directory(stream)
        height, width = tags["height"][0], tags["width"][0]
        bits = tags.get("bits", [1])
        samples = tags.get("samples", [1])[0]
        compression = tags.get("compression", [1])[0]
        photometric = tags.get("photometric", [-1])[0]
        planar = tags.get("planar", [1])[0]
        per_strip = min(tags.get("rows_per_strip", [height])[0], height)
        whole = sum(tags.get("counts", [])) == height * width * 3
        problem = None
        if following:
            problem = "expected single-page TIFF"
        elif set(bits) != {8} or samples != 3 or tags.get("format", [1])[0] != 1 or planar != 1:
            problem = "expected uint8 RGB TIFF"
        record.update(
            width=width, height=height, bits=bits[0], samples=samples,
            compression=COMPRESSIONS.get(compression, str(compression)),
            photometric=PHOTOMETRICS.get(photometric, str(photometric)), pages=2 if following else 1,
            strips=compression == 1 and planar == 1 and photometric == 2 and "tile_width" not in tags and whole,
            rows_per_strip=per_strip, offsets=tags.get("offsets", []), problem=problem)
    except (ValueError, KeyError, IndexError, struct.error):
        record.update(problem="unreadable TIFF")
    return record


def tiff_headers(files: DataFrame) -> DataFrame:
    """Size, layout, digest and fitness of each TIFF of a listing, one pass per file."""
    fields = [part.strip().split(" ")[0] for part in HEADER.split(", ")]

    def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_header(r.relpath, r.path, r.bytes) for r in batch.itertuples()]
            yield pd.DataFrame(rows, columns=fields).astype(object).where(lambda d: d.notna(), None)

    return dealt(files.select("relpath", "path", "bytes"), files).mapInPandas(inspect, HEADER)


def require_rgb(headers: DataFrame) -> None:
    """Stop when any raster is not a single-page 8-bit RGB TIFF."""
    bad = headers.filter(F.col("problem").isNotNull()).select("relpath", "problem").head()
    if bad:
        raise ValueError(f"{bad.problem}: {bad.relpath}")


def strip_rows(headers: DataFrame) -> DataFrame:
    """``image, row_no, height, px`` of uncompressed TIFFs, read in chunks at file offsets."""
    line = F.col("width").cast("bigint") * 3
    per_chunk = F.greatest(F.lit(1), F.floor(F.lit(CHUNK_BYTES) / line))
    strips = headers.filter("strips").select(
        F.col("relpath").alias("image"), "path", "height", line.alias("line"), per_chunk.alias("per_chunk"),
        "rows_per_strip", F.posexplode("offsets").alias("strip", "offset"))
    strips = strips.withColumn("first", F.col("strip") * F.col("rows_per_strip")).withColumn(
        "rows", F.least(F.col("rows_per_strip"), F.col("height") - F.col("first")))
    chunks = strips.filter(F.col("rows") > 0).withColumn("skip", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("rows") - 1, F.col("per_chunk").cast("bigint"))))
    chunks = chunks.select(
        "image", "path", "height", "line", (F.col("first") + F.col("skip")).alias("row_no"),
        F.least(F.col("per_chunk"), F.col("rows") - F.col("skip")).cast("bigint").alias("rows"),
        (F.col("offset") + F.col("skip") * F.col("line")).alias("offset"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for chunk in batch.itertuples():
                with open_file(chunk.path) as stream:
                    stream.seek(chunk.offset)
                    data = stream.read(chunk.rows * chunk.line)
                if len(data) != chunk.rows * chunk.line:
                    raise ValueError(f"truncated TIFF: {chunk.image}")
                held.append((chunk, data))
                size += len(data)
                if size >= CHUNK_BYTES // 4:
                    yield _lines(held)
                    held, size = [], 0
        if held:
            yield _lines(held)

    return dealt(chunks, headers, "row_no").mapInPandas(read, ROWS)


def _lines(chunks: list[tuple]) -> pd.DataFrame:
    """Scan lines of the chunks that were read."""
    counts = [chunk.rows for chunk, _ in chunks]
    return pd.DataFrame({
        "image": np.repeat(np.array([chunk.image for chunk, _ in chunks], object), counts),
        "row_no": np.concatenate([np.arange(chunk.row_no, chunk.row_no + chunk.rows, dtype=np.int32) for chunk, _ in chunks]),
        "height": np.repeat(np.array([chunk.height for chunk, _ in chunks], np.int32), counts),
        "px": [data[at:at + chunk.line] for chunk, data in chunks for at in range(0, len(data), chunk.line)]})


class _RowReader:
    """Rows of one uncompressed TIFF in ascending order, holding only the part in use."""

    def __init__(self, path: str):
        self.stream = open_file(path)
        tags, _ = _tiff_directory(self.stream)
        self.width, self.height = tags["width"][0], tags["height"][0]
        self.per_strip = min(tags.get("rows_per_strip", [self.height])[0], self.height)
        self.offsets, self.line = tags["offsets"], 3 * self.width
        self.first = self.last = 0
        self.rows = np.zeros((0, self.line), np.uint8)

    def _load(self, first: int, last: int) -> np.ndarray:
        parts = []
        while first < last:
            strip, inside = divmod(first, self.per_strip)
            count = min(self.per_strip - inside, last - first)
            self.stream.seek(self.offsets[strip] + inside * self.line)
            parts.append(self.stream.read(count * self.line))
            first += count
        return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, self.line)

    def block(self, top: int, height: int) -> np.ndarray:
        """Whole rows of bytes; rows in use by the block before are kept."""
        if not 0 <= top <= self.height - height:
            raise ValueError("window outside the raster")
        if top < self.first or top + height > self.last:
            kept = self.rows[max(top - self.first, 0):] if self.first <= top < self.last else self.rows[:0]
            start = self.last if len(kept) else top
            end = min(self.height, max(top + height, start + max(1, CHUNK_BYTES // self.line)))
            self.rows = np.concatenate([kept, self._load(start, end)])
            self.first, self.last = start - len(kept), end
        return self.rows[top - self.first:top - self.first + height]

    def window(self, left: int, top: int, width: int, height: int) -> np.ndarray:
        if not 0 <= left <= self.width - width:
            raise ValueError("window outside the raster")
        return self.block(top, height)[:, 3 * left:3 * (left + width)].reshape(height, width, 3)


def _read_windows(boxes: DataFrame, keys: Sequence[str], values: dict, reduce: Callable) -> DataFrame:
    """Apply ``reduce`` to the file, lefts and tops of runs of boxes, next to the file they come from.

    Boxes are range-partitioned by file and row, so each task walks down a stretch of one
    raster and reads its bytes once; a crowded stretch is split over tasks by the key. No
    pixels are shuffled.
    """
    kept = boxes.select(*keys, "path", F.col("left").cast("bigint").alias("left"), F.col("top").cast("bigint").alias("top"))
    schema = T.StructType([kept.schema[name] for name in keys] + [T.StructField(k, v) for k, v in values.items()])
    names = list(keys)

    def gathered(parts: list[tuple]) -> pd.DataFrame:
        """Runs of one batch, which follow each other, with their values."""
        batch, first, last = parts[0][0], parts[0][1], parts[-1][2]
        columns = {name: [value for part in parts for value in part[3][n]] for n, name in enumerate(values)}
        return batch.iloc[first:last][names].reset_index(drop=True).assign(**columns)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, current, held, rows = None, None, [], 0
        for batch in batches:
            if not len(batch):
                continue
            paths = batch["path"].to_numpy()
            new = np.flatnonzero(paths[1:] != paths[:-1]) + 1
            for first, last in zip([0, *new], [*new, len(batch)]):
                if paths[first] != current:
                    if reader:
                        reader.stream.close()
                    reader, current = _RowReader(paths[first]), paths[first]
                for at in range(first, last, RUN):
                    part = batch.iloc[at:min(at + RUN, last)]
                    held.append((batch, at, min(at + RUN, last), reduce(reader, part["left"].to_numpy(), part["top"].to_numpy())))
                    rows += len(part)
                    if rows >= RUN:
                        yield gathered(held)
                        held, rows = [], 0
            if held:
                yield gathered(held)
                held, rows = [], 0

    tasks = work_partitions(boxes.sparkSession)
    ordered = kept.repartitionByRange(tasks, "path", "top", *keys).sortWithinPartitions("path", "top")
    return ordered.mapInPandas(read, schema)


def read_patches(boxes: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """``keys, pixels`` of ``size`` x ``size`` boxes ``keys, path, left, top`` in uncompressed TIFFs."""
    def cut(reader: _RowReader, lefts: np.ndarray, tops: np.ndarray) -> tuple[list[bytes]]:
        return ([reader.window(left, top, size, size).tobytes() for left, top in zip(lefts.tolist(), tops.tolist())],)
    return _read_windows(boxes, keys, {"pixels": T.BinaryType()}, cut)


def read_spreads(boxes: DataFrame, keys: Sequence[str], side: int) -> DataFrame:
    """``keys, spread`` of square windows: n * sum(s^2) - (sum s)^2 of the channel sums.

    Windows that lie close share two summed-area tables, so each takes four look-ups a table whatever its size.
    """
    def spreads(reader: _RowReader, lefts: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray]:
        if len(lefts) and not (0 <= lefts.min() and lefts.max() <= reader.width - side):
            raise ValueError("window outside the raster")
        found = np.empty(len(lefts), np.int64)
        for cluster in _clusters(lefts, tops, side, max(side, TABLE_CELLS // reader.width)):
            left, top = lefts[cluster], tops[cluster]
            first, last, above, below = left.min(), left.max() + side, top.min(), top.max() + side
            block = reader.block(int(above), int(below - above))[:, 3 * first:3 * last]
            found[cluster] = window_spreads(block.reshape(below - above, last - first, 3), left - first, top - above, side)
        return (found,)
    return _read_windows(boxes, keys, {"spread": T.LongType()}, spreads)


def _clusters(lefts: np.ndarray, tops: np.ndarray, side: int, most_rows: int) -> Iterator[np.ndarray]:
    """Windows in ascending order of ``top`` dealt into clusters: stretches of rows, cut at gaps between the columns."""
    at = 0
    while at < len(tops):
        end = int(np.searchsorted(tops, tops[at] + most_rows - side, side="right"))
        order = at + np.argsort(lefts[at:end], kind="stable")
        reach = lefts[order] + side
        apart = np.flatnonzero(lefts[order][1:] > reach[:-1]) + 1
        # Long chains of touching windows are cut where they fill a table.
        wide = max(side, TABLE_CELLS // (tops[end - 1] - tops[at] + side))
        for chain in np.split(order, apart):
            yield from np.split(chain, np.flatnonzero(np.diff((lefts[chain] - lefts[chain[0]]) // wide)) + 1)
        at = end


def window_spreads(pixels: np.ndarray, lefts: np.ndarray, tops: np.ndarray, side: int) -> np.ndarray:
    """n * sum(s^2) - (sum s)^2 of the channel sums in each ``side`` x ``side`` window of ``height x width x 3`` pixels."""
    grey = pixels.sum(axis=2, dtype=np.int64)

    def sums(values: np.ndarray) -> np.ndarray:
        table = np.zeros((values.shape[0] + 1, values.shape[1] + 1), np.int64)
        np.cumsum(np.cumsum(values, axis=0), axis=1, out=table[1:, 1:])
        return table[tops + side, lefts + side] - table[tops, lefts + side] - table[tops + side, lefts] + table[tops, lefts]

    return side * side * sums(grey * grey) - sums(grey) ** 2


def image_rows(spark: SparkSession, paths: list[str], root: str) -> DataFrame:
    """``image, row_no, height, px`` of files Spark's image source can decode, pixels as stored."""
    if not paths:
        return spark.createDataFrame([], ROWS)
    if any(MEMBER.fullmatch(path) for path in paths):
        raise ValueError("JPEG and compressed rasters must be files of their own, not of a packed tree")
    base = qualified(spark, root)
    picture = spark.read.format("image").load(paths)
    origin = decode_origin(F.col("image.origin"))
    rows = picture.select(
        relative_to(origin, base).alias("image"), F.col("image.width").alias("width"),
        F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
        F.explode(F.sequence(F.lit(0), F.col("image.height") - 1)).alias("row_no"))
    line = F.col("width") * F.col("channels")
    raw = rows.select("image", "row_no", "height", "channels",
                      F.substring("data", F.col("row_no") * line + 1, line).alias("raw"))
    # The source stores BGR.
    return raw.select("image", "row_no", "height", swap_red_blue(three_channels("raw", "channels")).alias("px"))


@F.pandas_udf(T.BinaryType())
def three_channels(rows: pd.Series, channels: pd.Series) -> pd.Series:
    """Grey rows repeated to three channels, a fourth channel dropped."""
    def fit(row: bytes, count: int) -> bytes:
        if count == 3:
            return row
        pixels = np.frombuffer(row, np.uint8).reshape(-1, count)
        return (pixels.repeat(3, axis=1) if count == 1 else pixels[:, :3]).tobytes()
    return pd.Series([fit(r, c) for r, c in zip(rows, channels)], dtype=object)


def decode_origin(origin: Column) -> Column:
    """The image source percent-encodes its paths; bring them to the form of other sources."""
    plain = F.url_decode(F.replace(origin, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


JPEG_HEADER = ("relpath string, sha256 string, bytes bigint, width int, height int, mode string, "
               "exif_orientation int, decoder string")


def _jpeg_facts(stream) -> dict:
    """Size, colour mode and EXIF orientation from the markers before the pixel data."""
    facts = {"width": None, "height": None, "mode": None, "exif_orientation": None}
    stream.seek(2)
    while True:
        head = stream.read(4)
        if len(head) < 4 or head[0] != 0xFF or head[1] == 0xDA:
            return facts
        body = stream.read(struct.unpack(">H", head[2:])[0] - 2)
        if 0xC0 <= head[1] <= 0xCF and head[1] not in (0xC4, 0xC8, 0xCC):
            height, width, parts = struct.unpack_from(">HHB", body, 1)
            facts.update(width=width, height=height, mode={1: "L", 3: "RGB", 4: "CMYK"}.get(parts))
        elif head[1] == 0xE1 and body.startswith(b"Exif\0\0"):
            facts["exif_orientation"] = _exif_orientation(body[6:])


def _exif_orientation(block: bytes) -> int | None:
    order = {b"II": "<", b"MM": ">"}.get(block[:2])
    if not order or len(block) < 10:
        return None
    stream = io.BytesIO(block)
    stream.seek(struct.unpack_from(order + "I", block, 4)[0])
    for _ in range(struct.unpack(order + "H", stream.read(2))[0]):
        entry = stream.read(12)
        if len(entry) == 12 and struct.unpack_from(order + "H", entry)[0] == 274:
            return struct.unpack_from(order + "H", entry, 8)[0]
    return None


def jpeg_headers(files: DataFrame) -> DataFrame:
    """Digest, size, mode and recorded (not applied) EXIF orientation of each twin."""
    fields = [part.strip().split(" ")[0] for part in JPEG_HEADER.split(", ")]

    def inspect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file in batch.itertuples():
                with open_file(file.path) as stream:
                    facts = _jpeg_facts(stream)
                rows.append({"relpath": file.relpath, "sha256": stream_sha256(file.path), "bytes": file.bytes,
                             "decoder": "Spark image source", **facts})
            yield pd.DataFrame(rows, columns=fields).astype(object).where(lambda d: d.notna(), None)

    return dealt(files.select("relpath", "path", "bytes"), files).mapInPandas(inspect, JPEG_HEADER)
