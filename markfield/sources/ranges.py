"""Digest trees over byte ranges, so that one large file is hashed and checked by many tasks.

A file is cut into ranges of equal length; each is one row of work. Up to ``fan`` neighbouring digests make one digest of
the next level until one is left, the root. A file of one range has the plain digest of its bytes as its root. A
changed byte shows as one differing range, which names where in the file it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from markfield.operators.skew import TASK_BYTES, row_partitions, settle
from markfield.sources.files import open_file
from markfield.sources.packs import place

RANGE_BYTES = 64 << 20
FAN = 1_024
READ_BYTES = 8 << 20
#: Ranges that one task digests, and the most neighbouring bytes that are dealt as one.
TASK_RANGES, STRETCH_BYTES = 200_000, 1 << 20


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``relpath, file, range_no, start, length, at`` of every file of a listing; an empty file has one empty range.

    ``file`` is what to open and ``at`` the range's first byte in it: for a packed file the pack and the place there.
    """
    file, first = place(F.col("path"))
    numbered = files.select("relpath", file.alias("file"), first.alias("first"), "bytes",
                            F.explode(F.sequence(F.lit(0).cast("bigint"), _ranges_of(range_bytes) - 1)).alias("range_no"))
    start = F.col("range_no") * range_bytes
    return numbered.select("relpath", "file", "range_no", start.alias("start"),
                           F.least(F.lit(range_bytes).cast("bigint"), F.col("bytes") - start).alias("length"), (F.col("first") + start).alias("at"))


def _ranges_of(range_bytes: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col("bytes") / range_bytes)).cast("bigint")


def range_digests(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``relpath, range_no, start, length, sha256``, in the shared folder; ranges are dealt out whatever file they are in.

    Tasks follow the bytes and the number of the ranges. A stretch of neighbouring bytes is read by one task, in one go.
    """
    total, count = files.agg(F.sum("bytes"), F.sum(_ranges_of(range_bytes))).head()
    spark = files.sparkSession
    tasks = max(row_partitions(spark, total or 0, TASK_BYTES), row_partitions(spark, count or 0, TASK_RANGES))
    # Many stretches a task, so that tasks are alike.
    stretch = min(max((total or 0) // (64 * tasks), 4_096), STRETCH_BYTES)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name = stream = None
        try:
            for batch in batches:
                found = []
                for relpath, file, at, length in zip(batch["relpath"], batch["file"], batch["at"].tolist(), batch["length"].tolist()):
                    if file != name:
                        if stream is not None:
                            stream.close()
                        name, stream, block, first = file, open_file(file), memoryview(b""), 0
                    state, end, limit = hashlib.sha256(), at + length, (at // stretch + 1) * stretch
                    while at < end:
                        if not first <= at < first + len(block):
                            stream.seek(at)
                            first, block = at, memoryview(stream.read(min(max(end, limit) - at, READ_BYTES)))
                            if not block:
                                raise ValueError(f"{relpath} became shorter")
                        part = block[at - first:end - first]
                        state.update(part)
                        at += len(part)
                    found.append(state.hexdigest())
                yield batch.drop(columns=["file", "at"]).assign(sha256=found)
        finally:
            if stream is not None:
                stream.close()

    # Empty ranges lie at one place however many there are.
    spread = F.when(F.col("length") == 0, F.xxhash64("relpath"))
    dealt = byte_ranges(files, range_bytes).repartition(tasks, "file", F.floor(F.col("at") / stretch), spread).sortWithinPartitions("file", "at")
    return settle(dealt.mapInPandas(digest, "relpath string, range_no bigint, start bigint, length bigint, sha256 string"), "range_digests")


def tree_roots(ranges: DataFrame, fan: int = FAN) -> DataFrame:
    """``relpath, bytes, root`` from the digests of all ranges; a node gathers at most ``fan`` digests and their bytes."""
    nodes = ranges.select("relpath", F.col("range_no").alias("no"), F.col("length").alias("bytes"), "sha256")
    last, count = ranges.agg(F.max("range_no"), F.count(F.lit(1))).head()
    most, tasks = (last or 0) + 1, row_partitions(ranges.sparkSession, count)
    while most > 1:
        told = F.array_sort(F.collect_list(F.struct("no", "sha256")))
        above = nodes.withColumn("parent", F.floor(F.col("no") / fan)).repartition(tasks, "relpath", "parent")
        parents = above.groupBy("relpath", "parent").agg(F.sum("bytes").alias("bytes"), told.alias("told")).select(
            "relpath", F.col("parent").alias("no"), "bytes", F.when(F.size("told") == 1, F.col("told")[0]["sha256"]).otherwise(F.sha2(F.unhex(
                F.array_join(F.transform("told", lambda node: node["sha256"]), "")), 256)).alias("sha256"))
        nodes, most = settle(parents, "tree_level"), -(-most // fan)
    return nodes.select("relpath", "bytes", F.col("sha256").alias("root"))


def changed_ranges(recorded: DataFrame, present: DataFrame) -> DataFrame:
    """``relpath, range_no, start, length`` of ranges that differ, are gone or are new."""
    now = present.select("relpath", "range_no", F.col("start").alias("_start"), F.col("length").alias("_length"), F.col("sha256").alias("_sha256"))
    joined = recorded.join(now, ["relpath", "range_no"], "full")
    return joined.filter(~F.col("sha256").eqNullSafe(F.col("_sha256"))).select(
        "relpath", "range_no", F.coalesce("start", "_start").alias("start"), F.coalesce("length", "_length").alias("length"))
