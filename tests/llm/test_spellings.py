"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from markfield.llm import spellings
from tests.llm.support import documents, hard_rows, prose


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {word: n for word, n in found.items() if len(word) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(words):
    beside = {a: [b for b in words if a != b and abs(len(a) - len(b)) < 2 and near(a, b)] for a in words}
    form = {}
    for word, others in beside.items():
        best = min(others, key=lambda w: (-words[w], w), default=None)
        form[word] = best if best and words[best] >= 10 * words[word] else None
    rows = set()
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, n, len(beside[word]), words[form[word]] if form[word] else None))
    return rows


def got(frame):
    return [tuple(row) for row in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def altered(draw, word, letters="abcdeé"):
    at = draw.randrange(len(word))
    return draw.choice([word[:at] + word[at + 1:], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1:]])


def crowd(seed, bases=12, variants=25):
    """Words of few letters, so that many vectors agree, with variants of variants."""
    draw, said = random.Random(seed), []
    for _ in range(bases):
        word = "".join(draw.choices("abcdeé", k=draw.randint(7, 12)))
        said += [word] * 400
        for _ in range(variants):
            said += [altered(draw, word)] * draw.choice([2, 3, 30])
            said += [altered(draw, altered(draw, word))] * 2
    draw.shuffle(said)
    return [(n, " ".join(said[low:low + 200])) for n, low in enumerate(range(0, len(said), 200))]


def test_hard_rows(spark):
    rows = hard_rows() + [(20, "Écoles ÉCOLESX écolesx Écolesx × ÷ x"), (21, "écolesx ÀÀÀÀÀÀÀ ÀÀÀÀÀÀÀ"), (22, "a" * 5_001 + " " + "a" * 5_001)]
    found = got(spellings.variants(documents(spark, rows)))
    assert set(found) == grouped(counted(rows)) and len(set(found)) == len(found)
    assert spellings.variants(documents(spark, [])).count() == 0


def test_crowded_words(spark):
    rows = crowd(1)
    found = got(spellings.variants(documents(spark, rows)))
    want = grouped(counted(rows))
    assert set(found) == want and len(found) == len(want)
    assert any(row[2] not in (row[0], row[1]) for row in want)  # chains of forms


@pytest.mark.parametrize(("shard", "levels"), [(10**6, 8), (200, 8), (5, 2), (5, 8), (3, 0)])
def test_any_shards_give_the_same(spark, shard, levels):
    words = counted(crowd(2))
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spellings.near_words(frame, shard=shard, levels=levels).collect()
    want = {a: [b for b in words if a != b and near(a, b)] for a in words}
    want = {a: (len(b), min(b, key=lambda w: (-words[w], w))) for a, b in want.items() if b}
    assert {r.word: (r.n_near, r.best) for r in found} == want and len(found) == len(want)


def test_small_batches_down_the_trie(monkeypatch):
    monkeypatch.setattr(spellings, "ASKING", 7)
    monkeypatch.setattr(spellings, "COMPARED", 64)
    words = counted(crowd(3, 4, 15))
    table = pa.table({"word": list(words), "n": list(words.values())})
    found = spellings.searched(table, table, ["ab", "c", "deé"]).to_pylist()
    assert {r["word"]: r["n_near"] for r in found} == {
        a: n for a in words if (n := sum(near(a, b) for b in words if a != b))}


def test_prose(spark):
    rows = [(n, prose(n % 7, 400)) for n in range(40)]
    assert set(got(spellings.variants(documents(spark, rows, ("word", "n", "form"))))) == grouped(counted(rows))
