"""The prefix trie against nested dictionaries."""

import hashlib
import random
import zlib

import pytest

from markfield.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, head string, depth string"


def tree(rows):
    told = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            told.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    told = {conv: [turn[1:] for turn in sorted(turns)] for conv, turns in told.items()}
    nodes = {}
    for conv, turns in told.items():
        h = zlib.crc32(str(conv).encode()) % 9
        again = told.get(conv - conv % 5, [])[:h] + turns[h:]
        for depth in range(len(again) + 1):
            node = nodes.setdefault(tuple(again[:depth]), {"members": [], "ends": []})
            node["members"].append(conv)
        node["ends"].append(conv)
    for path, node in nodes.items():
        node |= {"children": 0, "leaves": 0, "saved": 0}
    for path, node in nodes.items():
        if path:
            nodes[path[:-1]]["children"] += 1
    for path, node in nodes.items():
        for depth in range(len(path) + 1):
            above = nodes[path[:depth]]
            above["leaves"] += not node["children"]
            above["saved"] += (len(node["members"]) - 1) * len(path[-1][1].encode()) if path else 0
    return sorted(((min(node["members"]), len(path), min(nodes[path[:-1]]["members"]) if path else None, len(node["members"]), node["children"],
                    node["leaves"], node["saved"], hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest())
                   for path, node in nodes.items()), key=str)


def drawn(seed, convs):
    draw, rows = random.Random(seed), []
    for conv in range(convs):
        for turn in range(draw.randint(1, 12)):
            rows.append((conv * draw.choice([1, 1, 1, 3]) - 7, turn, draw.choice(["user", "assistant"]) if draw.random() < 0.3 else "user",
                         draw.choice(["é", "yes", "", "no"]) if turn else draw.choice(["hello"] * 5 + ["hi"]), "x", "x"))
    return rows


HARD = [(None, 0, "user", "lost", "x", "x"), (0, None, None, None, "x", "x"), (0, None, None, None, "x", "x"), (0, 1, "user", "a:b", "x", "x"),
        (0, 1, "user", "a:b", "x", "x"), (1, 0, "user:a", "b", "x", "x"), (2, 0, "user", ":ab", "x", "x"), (3, 0, "4", "user", "x", "x"),
        (4, 5, "", "", "x", "x"), (-3, 0, "user", "ü" * 50_000, "x", "x"), (-5, 0, "user", "q", "x", "x"), (50, 2, None, "t", "x", "x")]


@pytest.mark.parametrize("container", [1_000, 40, 1])
def test_against_dictionaries(spark, container):
    rows = drawn(4, 300) + HARD
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), container)
    assert sorted(map(tuple, found.collect()), key=str) == tree(rows)


def test_turnless_conversations(spark):
    lone = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(lone, 0, "user", "gone", "x", "x")]
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in found] == tree(rows) and found[0].depth == 0


def test_many_copies_end_together(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 16)
    rows = [(5 * n, turn, "user", f"same {turn}", "x", "x") for n in range(400) for turn in range(3)]
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA), 1)
    assert sorted(map(tuple, found.collect()), key=str) == tree(rows)


def test_long_conversations_share_a_beginning(spark):
    rows = [(5 * n, turn, "user", "end" if turn == 4_000 - n else "go", "x", "x") for n in range(4) for turn in range(4_000)]
    found = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(r.depth for r in found) == 4_000 and sum(r.n_children == 0 for r in found) == 4
    root = next(r for r in found if r.depth == 0)
    assert root.n_leaves == 4 and root.saved_tokens == sum(r.saved_tokens for r in found if r.depth == 1)


def test_empty(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
