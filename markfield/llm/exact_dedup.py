"""Exact deduplication by a stream with disk-backed keyed state that never expires.

A feed of ``(digest, identifier, locator)`` rows is read by Structured Streaming into a keyed
aggregate whose state lies in RocksDB. Per digest the state keeps the largest identifier, where
that row's content lies (file and row number) and how many rows came. There is no watermark, so a
copy is found however late it arrives. Every batch writes the keys it changed under its own batch
number; a batch that runs again replaces its own output. On hits (digests of several rows) the full
texts are compared, and a digest whose texts differ is regrouped by the texts themselves.

Only built-in functions are used. Null text counts as empty; equal identifiers are told apart by
the locator, so exactly one row of a group stays; a null identifier sorts before all others. Extra
columns pass through untouched; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import release, scratch, settle, small_side, table, whole

#: State on disk, one bound on the memory all its stores in an executor take together, no files reserved
#: ahead, and a store is closed when its task has committed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Digests of several rows are broadcast up to this counted number (about 80 bytes each), else shuffled.
BROADCAST_DIGESTS = 500_000


def located(docs: DataFrame) -> DataFrame:
    """``doc, file, row``: every row as one struct, and where its content lies.

    The struct keeps the caller's columns apart from the operators' own. Rows that do not come straight from files
    are written to the shared folder first.
    """
    doc = F.struct("*").alias("doc")
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    if "_metadata" not in docs.columns:
        try:
            return docs.select(doc, *place)
        except AnalysisException:
            pass
    return settle(docs.select(doc), "content").select("doc", *place)


def feed(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digest, id, file, row`` of located documents."""
    return rows.select(digest_of(text_col).alias("digest"), F.col("doc").getField(id_col).alias("id"), "file", "row")


def digest_of(text_col: str) -> Column:
    return F.unhex(F.sha2(whole(F.col("doc").getField(text_col)), 256))


def keyed_state(spark: SparkSession, feed_path: str, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Run the stream over all that lies in ``feed_path`` and return ``digest, keep, members``.

    ``folder`` holds the stream's checkpoint and the batch outputs: called again with the same folder it
    takes in only new files and the state goes on from where it was. ``keep`` is a struct of id, file, row.
    """
    schema = spark.read.parquet(feed_path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    state = reader.parquet(feed_path).groupBy("digest").agg(
        F.max(F.struct("id", "file", "row")).alias("keep"), F.count(F.lit(1)).alias("members"))

    def commit(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/changed/batch={batch}")

    before = {name: spark.conf.get(name, None) for name in STATE}
    for name, value in STATE.items():
        spark.conf.set(name, value)
    try:
        (state.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/stream")
         .trigger(availableNow=True).foreachBatch(commit).start().awaitTermination())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    empty = spark.createDataFrame([], state.schema)
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/changed")
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return empty
    changed = spark.read.parquet(f"{folder}/changed")
    last = changed.groupBy("digest").agg(F.max(F.struct("batch", "keep", "members")).alias("last"))
    return last.select("digest", "last.keep", "last.members")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            files_per_batch: int | None = None) -> DataFrame:
    """``doc`` (all columns of a row), ``digest, keep, members, kept``: the class of every row.

    ``keep`` is the struct (id, file, row) of the row of the class that stays. Key and state rows are small;
    texts move only for digests of several rows, combined before the shuffle to the least and greatest text.
    """
    spark = docs.sparkSession
    rows = located(docs)
    folder = scratch(spark, "exact-state")
    path = scratch(spark, "exact-feed")
    feed(rows, id_col, text_col).write.parquet(path)
    state = settle(keyed_state(spark, path, folder, files_per_batch), "exact-classes")
    release(folder)
    release(path)
    several = state.filter("members > 1")
    digested = rows.withColumn("digest", digest_of(text_col))
    text = whole(F.col("doc").getField(text_col))
    hits = digested.select("digest", text.alias("text")).join(
        small_side(several.select("digest"), several.count(), BROADCAST_DIGESTS), "digest", "left_semi")
    unequal = hits.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high")).filter("low <> high")
    unequal = settle(unequal.select("digest"), "exact-unequal")
    joined = digested.join(state, "digest", "left")
    if not unequal.isEmpty():
        joined = by_text(joined, unequal, id_col, text)
    here = F.struct(F.col("doc").getField(id_col).alias("id"), "file", "row")
    return joined.withColumn("kept", F.col("keep").eqNullSafe(here)).drop("file", "row")


def by_text(joined: DataFrame, unequal: DataFrame, id_col: str, text: Column) -> DataFrame:
    """Split digests shared by different texts: their rows are grouped by digest and text."""
    rows = joined.withColumn("text", text)
    parted = rows.join(unequal, "digest", "left_semi").groupBy("digest", "text").agg(
        F.max(F.struct(F.col("doc").getField(id_col).alias("id"), "file", "row")).alias("own"),
        F.count(F.lit(1)).alias("own_members"))
    both = rows.join(parted, ["digest", "text"], "left")
    return both.withColumn("keep", F.coalesce("own", "keep")).withColumn(
        "members", F.coalesce("own_members", "members")).select(*joined.columns)


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class of equal texts: that of the largest identifier."""
    return classes(docs, id_col, text_col).filter("kept").select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select("doc.doc_id", F.col("keep.id").alias("keep_id"), F.col("members").alias("group_size"), "kept",
                                F.lower(F.hex("digest")).alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
