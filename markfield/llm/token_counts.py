"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes (inserts, deletes, revised counts) is reduced to one signed row per key and written under
its batch id; Spark's success file of that folder is the commit. A batch that is committed already is left
alone, one that broke off is overwritten, so a batch counts once however often it is sent. Totals are sums over committed
batches; :meth:`Rollup.compact` folds them into one base that remembers their ids.

Changes are combined before the shuffle, so a hot source or language moves one row per task. Null sources and
languages are keys of their own; null text counts as empty; repeated rows are documents of their own until copies of
equal texts are deleted, whatever their ids; keys whose documents and tokens are both zero are left out of the totals.
Extra columns are ignored; no batches give no totals.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import scratch, settle, slices, table, whole
from markfield.llm.tokens import BYTE_BPE, MULTI_BPE, encoder

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def changes(rows: DataFrame, tokenizer: str, documents: int, tokens: Column) -> DataFrame:
    """Signed rows of one kind of change; ``rows`` has ``source`` and ``lang``."""
    return rows.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.lit(tokenizer).alias("tokenizer"), F.lit(documents).cast("long").alias("documents"),
                       tokens.cast("long").alias("tokens"))


def inserted(rows: DataFrame, tokenizer: str, count: str) -> DataFrame:
    return changes(rows, tokenizer, 1, F.col(count))


def deleted(rows: DataFrame, tokenizer: str, count: str) -> DataFrame:
    return changes(rows, tokenizer, -1, -F.col(count))


def revised(rows: DataFrame, tokenizer: str, before: str, after: str) -> DataFrame:
    return changes(rows, tokenizer, 0, F.col(after) - F.col(before))


class Rollup:
    """Committed deltas in a folder every executor reaches."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self, kind: str) -> list[str]:
        path, store = self._path(kind)
        names = [part.getPath().getName() for part in store.listStatus(path)] if store.exists(path) else []
        return sorted(name for name in names if self._exists(kind, name, "_SUCCESS"))

    def _exists(self, *parts: str) -> bool:
        path, store = self._path(*parts)
        return store.exists(path)

    def committed(self) -> set[str]:
        """Ids of all committed batches, folded ones included."""
        base = self._base()
        folded = {row.batch for row in self.spark.read.parquet(f"{self.folder}/{base}/batches").collect()} if base else set()
        return folded | set(self._folders("deltas"))

    def _base(self) -> str | None:
        bases = [name for name in self._folders("bases") if self._exists("bases", name, "batches", "_SUCCESS")]
        return f"bases/{bases[-1]}" if bases else None

    def apply(self, batch: str, batch_changes: DataFrame) -> bool:
        """Commit a batch unless it is committed already; says whether it was written."""
        if batch in self.committed():
            return False
        deltas = batch_changes.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch}")
        return True

    def _parts(self) -> list[str]:
        base = self._base()
        folded = {row.batch for row in self.spark.read.parquet(f"{self.folder}/{base}/batches").collect()} if base else set()
        fresh = [f"{self.folder}/deltas/{name}" for name in self._folders("deltas") if name not in folded]
        return ([f"{self.folder}/{base}"] if base else []) + fresh

    def _sums(self) -> DataFrame:
        parts = self._parts()
        rows = self.spark.read.schema(SCHEMA).parquet(*parts) if parts else self.spark.createDataFrame([], SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` over all committed batches."""
        return self._sums().filter((F.col("documents") != 0) | (F.col("tokens") != 0))

    def compact(self) -> None:
        """Fold all committed batches into a new base; deltas go only after the base and its list are committed."""
        done = sorted(self.committed())
        fresh = self._folders("deltas")
        if not fresh:
            return
        name = f"{len(self._folders('bases')):08d}"
        self._sums().write.mode("overwrite").parquet(f"{self.folder}/bases/{name}")
        self.spark.createDataFrame([(batch,) for batch in done], "batch string").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.folder}/bases/{name}/batches")
        for batch in fresh:
            path, store = self._path("deltas", batch)
            store.delete(path, True)


def counted(docs: DataFrame, vocabularies: Sequence[str], texts: dict[str, Column], carry: Sequence[str]) -> DataFrame:
    """The ``carry`` columns and, per text and vocabulary, the number of ids (``<text>_<position of vocabulary>``).

    Equal texts of a row are counted once. Written to the shared folder, so the ids are made once.
    """
    rows = docs.select(*carry, *(text.alias(f"_{name}") for name, text in texts.items()))
    names = [f"{name}_{n}" for name, n in itertools.product(texts, range(len(vocabularies)))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [encoder(vocabulary) for vocabulary in vocabularies]
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found: list[list[int]] = [[] for _ in names]
            for row in zip(*(column.to_pylist() for column in batch.columns[len(carry):])):
                seen: dict[str, list[int]] = {}
                for place, text in enumerate(row):
                    sizes = seen.get(text) or seen.setdefault(text, [len(encode(text)) for encode in encoders])
                    for n, size in enumerate(sizes):
                        found[place * len(encoders) + n].append(size)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carry)], *(pa.array(out, pa.int64()) for out in found)],
                                             names=[*carry, *names])

    kinds = [f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields[:len(carry)]]
    return settle(rows.mapInArrow(run, ", ".join([*kinds, *(f"{name} long" for name in names)])), "token-counts")


def collapsed(text: Column) -> Column:
    """White space at the ends removed and runs of it made one space."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def kept(counts: DataFrame) -> DataFrame:
    """One row of each text: that of the least id (a null id comes last), then of the least source, language and counts.

    Copies are combined before the shuffle and only one row a text is put out, so a text that a third of all rows share
    moves one row a task; rows alike in every column count as copies of each other.
    """
    rest = [name for name in counts.columns if name not in ("doc_id", "_digest")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("_unnamed"), "doc_id", *rest)).alias("_kept")
    return counts.groupBy("_digest").agg(first).select("_kept.*").drop("_unnamed")


def history(docs: DataFrame) -> list[tuple[str, DataFrame]]:
    """Batches a corpus goes through: all documents come in, copies of equal texts are deleted (one stays, see :func:`kept`),
    counts are revised where white space was collapsed, and a second tokenizer version counts what is left.

    The deletes are all documents less the ones that stay: a sum, so no row looks its text up.
    """
    rows = docs.withColumn("_digest", F.sha2(whole(), 256))
    counts = counted(rows, [BYTE_BPE, MULTI_BPE], {"raw": whole(), "clean": collapsed(whole())},
                     ["doc_id", "source", "lang", "_digest"])
    left = settle(kept(counts), "kept-counts")
    return [("0-insert", inserted(counts, BYTE_BPE, "raw_0")),
            ("1-delete", deleted(counts, BYTE_BPE, "raw_0").unionByName(inserted(left, BYTE_BPE, "raw_0"))),
            ("2-revise", revised(left.filter("raw_0 <> clean_0"), BYTE_BPE, "raw_0", "clean_0")),
            ("3-version", inserted(left, MULTI_BPE, "clean_1"))]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all batches; the second half is sent twice and folded between, as after a lost acknowledgement."""
    rollup = Rollup(spark, scratch(spark, "rollup"))
    batches = history(table(spark, sf_dir, "documents"))
    for batch, batch_changes in batches:
        rollup.apply(batch, batch_changes)
    rollup.compact()
    for batch, batch_changes in batches[2:]:
        rollup.apply(batch, batch_changes)
    return rollup.totals()
