"""Line templates against a brute-force count, and documents of many lines."""

import random
import re
import time
from collections import Counter, defaultdict

from markfield.llm import lines
from tests.llm.support import documents, hard_rows

SETTINGS = lines.Settings()


def tokens_of(line):
    line = re.sub(r"[\t\r\x0b\x0c ]+", " ", line).strip(" ")
    return re.sub(r"(?<![^ ])[^ 0-9]*[0-9][^ ]*", "<*>", line).split(" ") if line else []


def expected(rows):
    """Kept text and dropped lines per document, every count over sets of documents."""
    parsed = [[tokens_of(line) for line in (text or "").split("\n")] for _, text in rows]
    leaf = lambda tokens: (len(tokens), *tokens[:SETTINGS.leading])
    in_leaf, in_place, in_line = defaultdict(set), defaultdict(set), defaultdict(set)
    for at, told in enumerate(parsed):
        for tokens in filter(None, told):
            in_leaf[leaf(tokens)].add(at)
            in_line[tuple(tokens)].add(at)
            for place, token in enumerate(tokens):
                in_place[leaf(tokens), place, token].add(at)
    follows = defaultdict(set)
    for tokens, found in in_line.items():
        name = leaf(tokens)
        fixed = sum(len(in_place[name, place, token]) >= SETTINGS.share * len(in_leaf[name]) for place, token in enumerate(tokens))
        if len(in_leaf[name]) >= SETTINGS.documents and fixed and fixed >= SETTINGS.fixed * len(tokens):
            follows[name] |= found
    dropped = {tokens for tokens, found in in_line.items() if len(found) >= SETTINGS.documents}
    for tokens in in_line:
        name = leaf(tokens)
        fixed = sum(len(in_place[name, place, token]) >= SETTINGS.share * len(in_leaf[name]) for place, token in enumerate(tokens))
        if len(follows[name]) >= SETTINGS.documents and fixed >= SETTINGS.fixed * len(tokens) and len(in_leaf[name]) >= SETTINGS.documents:
            dropped.add(tokens)
    found = []
    for (doc_id, text), told in zip(rows, parsed):
        kept = [line for line, tokens in zip((text or "").split("\n"), told) if tuple(tokens) not in dropped or not tokens]
        found.append((doc_id, len(told), len(told) - len(kept), "\n".join(kept)))
    return Counter(found)


def told(draw):
    kind = draw.randrange(6)
    word = lambda: draw.choice("alpha beta gamma delta apples pears plums".split())
    return ["", f"the price of {word()} per unit is {draw.randint(1, 99)} today", f"page {draw.randint(1, 999)} of {draw.randint(1, 99)}",
            f"  one two\tthree {word()} {word()} ", " ".join(word() for _ in range(5)), f"read more about {word()} here now"][kind]


def test_templates_against_brute_force(spark):
    for seed, number in ((1, 40), (2, 12), (3, 6)):
        draw = random.Random(seed)
        rows = [(n, "\n".join(told(draw) for _ in range(draw.randint(0, 8)))) for n in range(number)] + hard_rows()
        found = lines.without_recurring(documents(spark, rows)).select("doc_id", "n_lines", "dropped", "text").collect()
        assert Counter(map(tuple, found)) == expected(rows)


def test_a_document_of_many_lines(spark):
    long = "\n".join(f"the price of item {'x' * (n % 7)} in row {n:x} w{n * 7919 % 50021:x}".replace("0", "o") for n in range(50_000))
    footers = [(n, f"unique words number{'abcdefgh'[n]} stand\nall rights are kept by us") for n in range(6)]
    start = time.monotonic()
    found = {r.doc_id: r for r in lines.without_recurring(documents(spark, [(9, long + "\nall rights are kept by us"), *footers], ())).collect()}
    assert time.monotonic() - start < 90
    assert found[9].n_lines == 50_001 and found[9].dropped == 1 and found[9].text == long
    assert all(found[n].dropped == 1 for n in range(6))
