import hashlib

import pytest
from pyspark.sql import functions as F

from markfield.llm import exact_dedup
from markfield.llm.common import scratch
from tests.llm.support import documents, hard_rows


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return {text: (max(ids, key=lambda i: (i is not None, i)), len(ids)) for text, ids in groups.items()}


def test_classes_of_hard_rows(spark):
    rows = hard_rows() + [(99, "")] * 50
    got = exact_dedup.classes(documents(spark, rows)).select(
        "doc.doc_id", "doc.text", F.col("keep.id").alias("keep_id"), F.col("members").alias("size"), "kept",
        F.lower(F.hex("digest")).alias("sha")).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    for row in got:
        assert (row.keep_id, row["size"]) == want[row.text or ""]
        assert row.sha == hashlib.sha256((row.text or "").encode()).hexdigest()
    kept = [row.text or "" for row in got if row.kept]
    assert sorted(kept) == sorted(want)  # exactly one row of each class, also among equal ids


def test_drop_keeps_columns_and_tables_without_rows(spark):
    docs = documents(spark, hard_rows())
    kept = exact_dedup.drop_exact(docs)
    assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
    assert exact_dedup.drop_exact(docs.filter("false")).count() == 0


def test_state_goes_on_over_runs(spark):
    folder, path = scratch(spark, "state"), scratch(spark, "feed")
    for part in ([(5, "a"), (1, "b")], [(7, "a")], [(2, "a"), (3, "c")]):
        exact_dedup.feed(exact_dedup.located(documents(spark, part))).write.mode("append").parquet(path)
        state = exact_dedup.keyed_state(spark, path, folder, files_per_batch=1)
        found = {row.keep.id: row.members for row in state.collect()}
    assert found == {7: 3, 1: 1, 3: 1}


def test_texts_of_one_digest_are_told_apart(spark, monkeypatch):
    """With a digest that collides on purpose, the whole texts decide."""
    monkeypatch.setattr(exact_dedup, "digest_of", lambda text_col: F.unhex(F.sha2(F.substring(
        F.coalesce(F.col("doc").getField(text_col), F.lit("")), 1, 1), 256)))
    rows = [(1, "ab"), (2, "ac"), (3, "ab"), (4, "x"), (5, None)]
    got = exact_dedup.classes(documents(spark, rows)).select("doc.doc_id", "keep.id", "members", "kept").collect()
    assert sorted(tuple(row) for row in got) == [(1, 3, 2, False), (2, 2, 1, True), (3, 3, 2, True), (4, 4, 1, True), (5, 5, 1, True)]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, None), (None, "")]])
def test_least_tables(spark, rows):
    got = exact_dedup.classes(documents(spark, rows)).select("members", "kept").collect()
    assert sum(row.kept for row in got) == min(1, len(rows)) and all(row.members == len(rows) for row in got)
