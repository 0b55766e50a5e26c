"""Building blocks that keep one hot key from landing in one task.

Plain ``groupBy`` aggregates are safe because they combine before the shuffle.
Three patterns are not and have a replacement here:

* looking a key up in a one-row-per-key table -> :func:`lookup_join`
* an exact median of a group of any size       -> :func:`exact_median`
* a running total inside a group of any size   -> :func:`running_total`
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

HOT_ROWS = 500_000
BROADCAST_KEYS = 100_000
#: File bytes of one task.
TASK_BYTES = 512 << 20
#: Narrow rows that one task sorts.
TASK_ROWS = 2_000_000
_JOB_FOLDER: ContextVar[str | None] = ContextVar("job_folder", default=None)
_LEFT: list[tuple[SparkSession, str]] = []


def work_partitions(spark: SparkSession, files: DataFrame | None = None, task_bytes: int = TASK_BYTES) -> int:
    """Task count for work that is far heavier than the rows describing it (files, row ranges).

    With a listing (column ``bytes``) it grows with the bytes to be read.

    Passed as an explicit number: a partitioning by column alone would be merged into
    very few tasks at run time, because the rows themselves are small.
    """
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    total = files.agg(F.sum("bytes")).head()[0] if files is not None else 0
    return max(least, -(-int(total or 0) // task_bytes))


def row_partitions(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Task count for a counted number of narrow rows, so that what a task sorts does not grow with the input."""
    return max(work_partitions(spark), -(-int(rows) // task_rows))


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key above ``hot_rows`` rows, with ``_fan``: how many parts of that size it makes."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return counts.select(*keys, F.ceil(F.col("_n") / hot_rows).cast("int").alias("_fan"))


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], spread_by: Sequence[str | Column], *,
    how: str = "left", hot_rows: int = HOT_ROWS, hot: DataFrame | None = None, strategy: str | None = None,
) -> DataFrame:
    """Join ``rows`` to ``table`` (one row per key) with hot keys split by how many rows they have.

    Rows of a hot key take a salt from a hash of ``spread_by`` (repeatable, so a lost
    task recomputes the same rows) and only the matching table rows are repeated.
    Rows without a key match nothing and take any salt. The hot keys are broadcast when there are few by count, else
    joined by a shuffle. ``strategy`` is a join hint for inputs whose size Spark cannot know before reading them.
    """
    keys = list(keys)
    hot = settle(hot_keys(rows, keys, hot_rows) if hot is None else hot.select(*keys, "_fan"), "hot_keys")
    number = hot.count()
    if not number:
        return rows.join(table.hint(strategy) if strategy else table, keys, how)
    hot = F.broadcast(hot) if number <= BROADCAST_KEYS else hot.hint("merge")
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce("_fan", F.lit(1 << 20))).cast("int")
    left = rows.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_fan").isNotNull() | no_key, salt).otherwise(F.lit(0))).drop("_fan")
    right = table.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1))).drop("_fan")
    return left.join(right.hint(strategy) if strategy else right, [*keys, "_salt"], how).drop("_salt")


def exact_median(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact middle values of a non-negative BIGINT column, per key.

    Returns ``keys, n, lower, upper``; the median is the mean of ``lower`` and
    ``upper``. Values are counted, then narrowed by their upper bits and then by the lower
    16, so a task sees counted ranges of a key and never its rows.
    """
    keys = list(keys)
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    high = F.shiftright(F.col(value).cast("bigint"), 16)
    buckets = counts.groupBy(*keys, high.alias("_hi")).agg(F.sum("_n").alias("_n"))
    whole = W.partitionBy(*keys)
    ranked = (
        buckets
        .withColumn("_before", F.sum("_n").over(whole.orderBy("_hi")) - F.col("_n"))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_r1", F.floor((F.col("_total") - 1) / 2).cast("bigint"))
        .withColumn("_r2", F.floor(F.col("_total") / 2).cast("bigint"))
    )

    def holds(rank: str) -> Column:
        return (F.col("_before") <= F.col(rank)) & (F.col(rank) < F.col("_before") + F.col("_n"))

    targets = ranked.filter(holds("_r1") | holds("_r2")).select(
        *keys, "_hi", F.col("_before").alias("_base"), "_total", "_r1", "_r2")
    inner = W.partitionBy(*keys, "_hi").orderBy(value)
    narrowed = (
        counts.withColumn("_hi", high).join(targets, [*keys, "_hi"])
        .withColumn("_before", F.col("_base") + F.sum("_n").over(inner) - F.col("_n"))
        .filter(holds("_r1") | holds("_r2"))
    )
    return narrowed.groupBy(*keys).agg(
        F.max("_total").alias("n"),
        F.min(F.when(holds("_r1"), F.col(value))).alias("lower"),
        F.max(F.when(holds("_r2"), F.col(value))).alias("upper"),
    )


def running_total(rows: DataFrame, keys: Sequence[str], order: str, value: str, name: str,
                  block: int = 4096) -> DataFrame:
    """Total of ``value`` over earlier rows of the same key (exclusive), by integer ``order``.

    Two levels: totals of order blocks are accumulated per key, rows only inside
    their block, so a long group is spread over many tasks.
    """
    keys = list(keys)
    blocked = rows.withColumn("_block", F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    totals = blocked.groupBy(*keys, "_block").agg(F.sum(value).alias("_sum"))
    over_blocks = W.partitionBy(*keys).orderBy("_block")
    bases = totals.select(*keys, "_block", (F.sum("_sum").over(over_blocks) - F.col("_sum")).alias("_base"))
    in_block = W.partitionBy(*keys, "_block").orderBy(order)
    return (
        blocked.join(bases, [*keys, "_block"])
        .withColumn(name, F.col("_base") + F.sum(value).over(in_block) - F.col(value))
        .drop("_block", "_base")
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``; only a local master may leave it unset."""
    context = spark.sparkContext
    folder = (spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
              or context.getCheckpointDir())
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-markfield-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


@contextmanager
def job_folder(spark: SparkSession) -> Iterator[str]:
    """Keep the intermediate tables of one job together and remove them when it ends."""
    folder = f"{shared_folder(spark)}/markfield-{uuid.uuid4().hex}"
    token = _JOB_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _JOB_FOLDER.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_left() -> None:
    """Remove the tables settled outside a job."""
    while _LEFT:
        spark, folder = _LEFT.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the JVM may be gone when the driver ends
            continue


def left_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared one; removed when its job, or else the driver, ends."""
    if job := _JOB_FOLDER.get():
        return f"{job}/{uuid.uuid4().hex}"
    folder = f"{shared_folder(spark)}/markfield-{uuid.uuid4().hex}"
    if not _LEFT:
        atexit.register(remove_left)
    _LEFT.append((spark, folder))
    return folder


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back.

    Used where several branches read the same costly result; the written table
    outlives lost executors and lets each branch read only its columns.
    """
    spark = rows.sparkSession
    target = f"{_JOB_FOLDER.get() or left_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target)
