"""Helpers the operators share: reading tables, tables in the shared folder, counted plan choices."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batch = TypeVar("Batch", pa.RecordBatch, pa.Array)
_FOLDERS: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce((F.col(text) if isinstance(text, str) else text).cast("string"), F.lit(""))


def slices(cells: Batch, rows: int = 256) -> Iterator[Batch]:
    """An Arrow batch or array in short pieces, so that a task holds few texts as Python objects at once."""
    for low in range(0, len(cells), rows):
        yield cells.slice(low, rows)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset (tests), one of this process is set."""
    context = spark.sparkContext
    folder = (spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
              or context.getCheckpointDir())
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; removed with :func:`release` or when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if not _FOLDERS:
        atexit.register(release)
    _FOLDERS[path] = spark
    return path


def release(path: str | None = None) -> None:
    """Remove one scratch path, or all of this process."""
    for folder in [path] if path else list(_FOLDERS):
        spark = _FOLDERS.pop(folder, None)
        if spark is None or spark.sparkContext._jsc is None:
            continue
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the JVM may be gone at exit; the folder is only scratch
            continue


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back: cuts lineage, outlives lost executors."""
    path = scratch(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def parts_for(rows: int, per_part: int) -> int:
    """How many parts of about ``per_part`` rows a counted table needs."""
    return max(1, math.ceil(rows / per_part))


def small_side(rows: DataFrame, counted: int, most: int) -> DataFrame:
    """``rows`` marked for broadcast when their counted number is at most ``most``; joined by shuffle otherwise."""
    return F.broadcast(rows) if counted <= most else rows.hint("merge")


#: DuckDB tables ``crc``: the steps of CRC-32 for every byte, from its polynomial. Follows WITH RECURSIVE.
CRC_SQL = """step AS (SELECT n, n::BIGINT AS v, 0 AS k FROM range(256) t(n)
  UNION ALL SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS cells FROM step WHERE k = 8)"""


def crc32_sql(text: str) -> str:
    """DuckDB's CRC-32 of a text expression's UTF-8, beside table ``crc``."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * octet_length(encode({text})), 2),
      lambda i: ('0x' || substr(hex(encode({text})), i, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, cells[xor(a & 255, b) + 1])), 4294967295)"""
