"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm import decontamination, exact_dedup, packing, simhash, toxicity
from markfield.llm.common import scratch, table
from markfield.llm.tokens import BYTE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the model is fitted on a bounded sample of the labelled ones."""
    model = toxicity.trained(spark, docs, sf_dir)
    return docs.filter(toxicity.score(spark, model, F.col("text")) < toxicity.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts stays: that with the largest doc_id."""
    return exact_dedup.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles, Jaccard 0.8 or more).

    Fingerprints and BK-trees give the first links, checked on whole texts; the exact shingle join finds those they miss.
    """
    return simhash.drop_near(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_leaked(docs, decontamination.test_items(spark, sf_dir))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All kept documents as pieces placed in sequences."""
    return packing.result(docs, BYTE_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaked),
    ("best_fit_packing", pack_sequences),
]
#: Tokenising and the learned stages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
