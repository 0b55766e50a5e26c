import random

import pytest
from pyspark.sql import functions as F

from markfield.llm import decontamination as D
from tests.llm.support import documents, hard_rows, prose


def items_of(count=40):
    return [(n, prose(n + 5000, 20 + n % 15) + ".", prose(n + 6000, 4 + n % 5)) for n in range(count)]


@pytest.mark.parametrize("threshold", [0.2, 0.5])
def test_search_equals_brute_force(threshold):
    items = items_of()
    settings = D.Settings(threshold=threshold, block=3, short=4)
    index = D.Index(items, settings)
    names = {number: term for term, number in index.terms.items()}
    draw = random.Random(1)
    for _ in range(60):
        text = prose(draw.randint(0, 10**6), 30) + " " + draw.choice(items)[1]
        words = D.words_of(text)[-64:]
        terms = sorted({index.terms[word] for word in words if word in index.terms})
        assert all(term in names for term in terms)
        want = {}
        for term in terms:
            posting = index.postings[term - 1]
            for segment, impact in zip(posting.segments, posting.impacts):
                want[segment] = want.get(segment, 0.0) + impact
        want = {segment: score for segment, score in want.items() if score >= threshold}
        got = {s: v for block in range(index.block_count) for s, v in index.search(terms, block)}
        assert got == pytest.approx(want)


def test_live_blocks_lose_nothing():
    import numpy as np

    items, settings = items_of(), D.Settings(block=2, short=3, cells=64)
    index = D.Index(items, settings)
    draw = random.Random(2)
    for _ in range(20):
        text = prose(draw.randint(0, 10**6), draw.randint(1, 400)) + " " + draw.choice(items)[1] + prose(draw.randint(0, 99), 70)
        words = D.words_of(text)
        ids = np.array([index.terms.get(word, 0) for word in words])
        passages = max(1, -(-len(words) // 32) - 1)
        live = set(index.live(ids, passages))
        for n in range(passages):
            terms = [t for t in np.unique(ids[n * 32:n * 32 + 64]).tolist() if t]
            for block in range(index.block_count):
                if index.search(terms, block):
                    assert (n, block) in live


def test_leaks_are_found_wherever_they_stand_and_clean_texts_are_left(spark):
    items = items_of()
    rows, want = [], {}
    for n in range(80):
        text = prose(n, 50 + 37 * n)
        if n % 2:
            item = items[n % 40]
            words = text.split()
            at = (n * 31) % len(words)
            leaked = f"{item[1]} {item[2]}" if n % 4 == 1 else item[1].upper().replace(" ", ",  ")
            text = " ".join(words[:at] + [leaked] + words[at:])
            want[n] = item[0]
        rows.append((n, text))
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    docs = documents(spark, rows)
    got = {(row.doc_id, row.item_id): row for row in D.leaks(docs, table).collect()}
    assert set(got) == set(want.items())
    assert all(row.question_overlap >= 0.8 for row in got.values())
    assert all((row.answer_overlap == 1.0) for (doc, _), row in got.items() if doc % 4 == 1)
    in_shards = D.Settings(shard_chars=500)
    assert {(r.doc_id, r.item_id) for r in D.leaks(docs, table, in_shards).collect()} == set(got)
    for settings in (D.Settings(), D.Settings(shard_chars=2000)):
        kept = D.drop_leaked(docs, table, settings)
        assert {r.doc_id for r in kept.collect()} == {n for n, _ in rows} - set(want) and kept.columns == docs.columns


def test_long_items_short_items_and_hard_rows(spark):
    long = prose(77, 700)
    items = [(1, long, "end of it"), (2, "two words", ""), (3, None, None), (4, "", ""), (5, "...", "!"), (6, prose(78, 30), None),
             (7, prose(78, 30), None)]
    table = spark.createDataFrame(items, "item_id long, question string, answer string")
    rows = hard_rows() + [(20, prose(3, 90) + " " + long + " " + prose(4, 90)), (21, "here are two words indeed"),
                          (22, "two other words"), (23, prose(78, 30)), (23, prose(78, 30))]
    got = sorted((row.doc_id, row.item_id) for row in D.leaks(documents(spark, rows), table).collect())
    assert got == [(20, 1), (21, 2), (23, 6), (23, 6), (23, 7), (23, 7)]
    assert D.leaks(documents(spark, []), table).count() == 0
    assert D.leaks(documents(spark, rows), table.filter("false")).count() == 0
    assert D.drop_leaked(documents(spark, rows), table.filter("false")).count() == len(rows)


def test_question_and_answer(spark):
    rows = spark.createDataFrame([("One two. Three four? Five six",), ("No end",), (None,), ("A.\nB.",)], "text string")
    question, answer = D.question_and_answer()
    assert [tuple(r) for r in rows.select(question, answer).collect()] == [
        ("One two. Three four?", "Five six"), ("No end", ""), ("", ""), ("A.", "B.")]


def test_partial_overlap_is_no_leak(spark):
    item = prose(500, 30)
    table = spark.createDataFrame([(1, item, "")], "item_id long, question string, answer string")
    rows = [(1, prose(1, 40) + " " + " ".join(item.split()[:18])), (2, " ".join(sorted(item.split())))]
    assert D.leaks(documents(spark, rows), table).select(F.col("doc_id")).count() == 0
