"""Folder listings, digests and small side files."""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.operators.skew import settle, work_partitions

RASTER_SUFFIXES = (".tif", ".tiff", ".jpg", ".jpeg")
#: Names in the root of a packed tree (``packs``), and the path of a file in it.
INDEX, PACKS = "_packed_index", "_packs"
MEMBER = re.compile(r"(.*/_packs/[0-9a-f]{32}\.pack)#(\d{15,})\+(\d+)")
#: Rows of a listing that leave a task at once, and file bytes that do.
LISTED, FRAME_BYTES = 10_000, 4 << 20
COPY_BYTES = 8 << 20


def qualified(spark: SparkSession, path: str) -> str:
    """Path as Spark's file sources report it: absolute, with scheme, unescaped."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(hadoop_path).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def relative_to(path: Column, root: str) -> Column:
    return F.substring(path, len(root) + 2, 1 << 30)


def listing(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (), hidden: bool = True) -> DataFrame:
    """``relpath, path, bytes, modified`` of the files below ``root``; no content is read.

    Folders are listed by tasks, one level of the tree per round. Spark's own file
    sources leave out empty files and names starting with ``_`` or ``.``, which are part
    of the input here. ``suffixes`` are compared without regard to case. Files of a
    packed tree come from its table.
    """
    from markfield.sources.packs import packed_listing

    base = qualified(spark, root)
    schema = "path string, folder boolean, bytes bigint, modified bigint"

    def children(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for folder in batch["path"]:
                yield from _children(folder)

    packed = exists(spark, f"{base}/{INDEX}/_SUCCESS")
    found, frontier = None, spark.createDataFrame([(base,)], "path string")
    while True:
        level = settle(frontier.mapInPandas(children, schema), "listing")
        if packed and found is None:
            level = level.filter(~F.col("path").isin(f"{base}/{INDEX}", f"{base}/{PACKS}"))
        files = level.filter("NOT folder")
        found = files if found is None else found.unionByName(files)
        frontier = level.filter("folder").select("path")
        if not frontier.head(1):
            break
        frontier = frontier.repartition(work_partitions(spark), "path")
    found = found.select(relative_to(F.col("path"), base).alias("relpath"), "path", "bytes", "modified")
    if packed:
        found = found.unionByName(packed_listing(spark, base))
    name = F.element_at(F.split("relpath", "/"), -1)
    if suffixes:
        found = found.filter(F.lower(name).rlike("(" + "|".join(re.escape(s) for s in suffixes) + ")$"))
    if not hidden:
        found = found.filter(~name.rlike("^[_.]"))
    return found


def _filesystem(path: str):
    """Filesystem object and the path inside it."""
    from pyarrow import fs

    if path.startswith("file:") or path.startswith("/"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def _children(folder: str) -> Iterator[pd.DataFrame]:
    """``path, folder, bytes, modified`` of what lies in a folder, a bounded number at a time where the system allows it."""
    from pyarrow import fs

    system, inner = _filesystem(folder)
    if isinstance(system, fs.LocalFileSystem):
        rows = (_entry(folder, entry) for entry in os.scandir(inner))
    else:
        rows = ((f"{folder}/{info.base_name}", info.type == fs.FileType.Directory, int(info.size or 0), int(info.mtime_ns or 0))
                for info in system.get_file_info(fs.FileSelector(inner)))
    while part := list(itertools.islice(rows, LISTED)):
        yield pd.DataFrame(part, columns=["path", "folder", "bytes", "modified"])


def _entry(folder: str, entry: os.DirEntry) -> tuple:
    path = f"{folder}/{entry.name}"
    try:
        at = entry.stat()
    except FileNotFoundError:  # a link to nothing
        return path, False, 0, 0
    return path, entry.is_dir(), 0 if entry.is_dir() else at.st_size, at.st_mtime_ns


class Member:
    """A file of a pack, read like a file of its own; the pack stays open for its neighbours."""

    def __init__(self, stream, start: int, size: int) -> None:
        self.stream, self.start, self.size, self.at = stream, start, size, 0

    def __enter__(self) -> Member:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        self.stream = None

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, count: int | None = None) -> bytes:
        left = max(self.size - self.at, 0)
        count = left if count is None else min(count, left)
        self.stream.seek(self.start + self.at)
        data = self.stream.read(count)
        if len(data) != count:
            raise ValueError("a pack became shorter")
        self.at += count
        return data


@lru_cache(maxsize=2)
def _pack(path: str):
    system, inner = _filesystem(path)
    return system.open_input_file(inner)


def open_file(path: str):
    """Seekable stream of a file on any filesystem the executors can reach."""
    if member := MEMBER.fullmatch(path):
        return Member(_pack(member[1]), int(member[2]), int(member[3]))
    system, inner = _filesystem(path)
    return system.open_input_file(inner)


def dealt(rows: DataFrame, files: DataFrame, *more: str) -> DataFrame:
    """``rows`` with a ``path`` dealt to the tasks their ``files`` need; neighbours of a pack stay together, in its order."""
    from markfield.sources.packs import stretch

    tasks = work_partitions(files.sparkSession, files)
    return rows.repartition(tasks, stretch(F.col("path")), *more).sortWithinPartitions("path", *more)


def read_contents(files: DataFrame) -> DataFrame:
    """``relpath, bytes, content`` of small files of a listing."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Each frame costs as much as many small files: one is full at some bytes, not at some files.
            full = (batch["bytes"].cumsum() // FRAME_BYTES).to_numpy()
            for _, part in batch.groupby(full, sort=False):
                data = []
                for path in part["path"]:
                    with open_file(path) as stream:
                        data.append(stream.read())
                yield pd.DataFrame({"relpath": part["relpath"], "bytes": part["bytes"], "content": data})

    return dealt(files.select("relpath", "path", "bytes"), files).mapInPandas(read, "relpath string, bytes bigint, content binary")


def write_contents(rows: DataFrame, root: str) -> int:
    """Write ``relpath, content`` as files below ``root``, from the tasks; returns how many."""
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for relpath, content in zip(batch["relpath"], batch["content"]):
                system, inner = _filesystem(f"{root}/{relpath}")
                system.create_dir(inner.rpartition("/")[0], recursive=True)
                with system.open_output_stream(inner) as stream:
                    stream.write(bytes(content))
            yield pd.DataFrame({"n": [len(batch)]})

    return int(rows.select("relpath", "content").mapInPandas(write, "n bigint").agg(F.sum("n")).head()[0] or 0)


def copy_tree(spark: SparkSession, source: str, target: str) -> int:
    """Copy every file below ``source`` to the same place below ``target``, a stretch at a time and from the tasks; returns how many."""
    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for relpath, path in zip(batch["relpath"], batch["path"]):
                system, inner = _filesystem(f"{target}/{relpath}")
                system.create_dir(inner.rpartition("/")[0], recursive=True)
                with open_file(path) as stream, system.open_output_stream(inner) as out:
                    while block := stream.read(COPY_BYTES):
                        out.write(block)
            yield pd.DataFrame({"n": [len(batch)]})

    files = listing(spark, source)
    return int(dealt(files.select("relpath", "path"), files).mapInPandas(copy, "n bigint").agg(F.sum("n")).head()[0] or 0)


def stream_sha256(path: str, chunk: int = 8 << 20) -> str:
    digest = hashlib.sha256()
    with open_file(path) as stream:
        while block := stream.read(chunk):
            digest.update(block)
    return digest.hexdigest()


def file_digests(files: DataFrame) -> DataFrame:
    """Add ``sha256`` to a listing; files are streamed in tasks, so size does not matter."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"relpath": batch["relpath"], "sha256": batch["path"].map(stream_sha256)})

    return dealt(files.select("relpath", "path"), files).mapInPandas(digest, "relpath string, sha256 string")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files of ``before`` that are gone or whose size or time differ in ``after``."""
    now = after.select("relpath", F.col("bytes").alias("_bytes"), F.col("modified").alias("_modified"))
    same = (F.col("bytes") == F.col("_bytes")) & (F.col("modified") == F.col("_modified"))
    return before.join(now, "relpath", "left").filter(~F.coalesce(same, F.lit(False))).select("relpath")


def read_table_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Dataset CSV with a header; a byte-order mark is accepted; all strings by default."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_string_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A JSON object of strings as rows ``key, value``; a byte-order mark is accepted."""
    text = spark.read.option("wholetext", True).text(path)
    clean = F.regexp_replace("value", "^﻿", "")
    return text.select(F.explode(F.from_json(clean, "map<string,string>")).alias(key, value))


def read_json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)
