import itertools
import random
import tempfile

import numpy as np
import pytest
import xxhash

from markfield.llm import shingle_join, simhash
from markfield.llm.components import components
from tests.llm.support import documents, hard_rows, prose, words


def slow_fingerprint(text, width=4):
    known = words(text)
    runs = [" ".join(known[n:n + width]) for n in range(len(known) - width + 1)] or ([" ".join(known)] if known else [])
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(values, radius=4):
    owner = list(range(len(values)))

    def root(n):
        while owner[n] != n:
            n = owner[n]
        return n

    for a, b in itertools.combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= radius:
            owner[root(a)] = root(b)
    return [root(n) for n in range(len(values))]


def near(value, draw, bits):
    for bit in draw.sample(range(64), bits):
        value ^= 1 << bit
    return value


def test_fingerprints_and_components_of_hard_rows(spark):
    rows = hard_rows() + [(100 + n, "") for n in range(40)]
    got = simhash.classes(documents(spark, rows)).collect()
    assert sorted((r.id is None, r.id or 0, r.fp & (2**64 - 1)) for r in got) == sorted(
        (i is None, i or 0, slow_fingerprint(t)) for i, t in rows)
    values = [slow_fingerprint(text) for _, text in rows]
    roots = slow_components(values)
    low = {}
    for (doc_id, _), group in zip(rows, roots):
        if doc_id is not None:
            low[group] = min(low.get(group, doc_id), doc_id)
    want = {(doc_id, value): low.get(group) for (doc_id, _), value, group in zip(rows, values, roots)}
    assert {(r.id, r.fp & (2**64 - 1)): r.component for r in got} == want


@pytest.mark.parametrize("shard", [20_000, 5])
def test_links_join_what_brute_force_joins(spark, shard):
    """Chains, a dense cluster in one shard, and strangers; parted shards give the same components."""
    draw = random.Random(1)
    values = [draw.getrandbits(64) for _ in range(60)]
    for _ in range(60):
        values.append(near(values[-1], draw, 3))  # a long chain
    centre = draw.getrandbits(64)
    values += [near(centre, draw, draw.randint(0, 4)) for _ in range(80)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v, [v]) for v in signed], "key long, fp array<long>")
    found = simhash.links(nodes, 4, simhash.pigeonhole(4, len(values)), shard=shard)
    got = {row.node: row.root for row in components(found).collect()}
    roots = slow_components(values)
    by = {}
    for v, group in zip(signed, roots):
        by.setdefault(group, set()).add(got.get(v, v))
    assert all(len(labels) == 1 for labels in by.values())
    assert len(set().union(*by.values())) == len(by)


def test_pigeonhole_choices_cover_all_pairs():
    draw = random.Random(2)
    for nodes in (10, 10**6, 10**9):
        masks = simhash.pigeonhole(4, nodes)
        for _ in range(300):
            a = draw.getrandbits(64)
            b = near(a, draw, draw.randint(0, 4))
            assert any((a ^ b) & (mask[0] & (2**64 - 1)) == 0 for mask in masks)


def test_tree_finds_all_within_radius():
    draw = random.Random(3)
    values = [draw.getrandbits(16) for _ in range(400)]
    tree = simhash.BKTree()
    for n, value in enumerate(values):
        tree.add(value, n)
    for value in values[:50]:
        assert sorted(tree.within(value, 4)) == [n for n, v in enumerate(values) if (v ^ value).bit_count() <= 4]


def test_dense_shard_gives_links_in_proportion():
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    values = list({near(centre, draw, 2) for _ in range(500)})
    assert len(simhash.shard_links(values, 4)) == len(values) - 1
    assert len(simhash.shard_links(values, 4, values, 4, nearest=3)) <= 4 * len(values)


def test_components_of_a_chain_a_star_and_loops(spark):
    chain = [(n, n + 1) for n in range(200)]
    star = [(1000, n) for n in range(1001, 1300)]
    rows = spark.createDataFrame(chain + star + [(5, 5), (201, 0)], "a long, b long")
    got = {r.node: r.root for r in components(rows).collect()}
    assert got == {n: 0 for n in range(1, 202)} | {n: 1000 for n in range(1001, 1300)}
    assert components(rows.filter("false")).count() == 0


def test_near_copies_leave_one_of_each_group(spark):
    """Word edits down to a shingle similarity of 0.8; strangers and other texts stay."""
    draw, rows, groups = random.Random(6), [], {}
    for base in range(60):
        text = prose(base + 100, 220)
        rows.append((base, text))
        groups[base] = {base}
        for copy in range(2):
            parts = text.split()
            for at in draw.sample(range(10, 210, 6), 4):
                parts[at] = "edited" + str(draw.random())[2:8]
            doc_id = 1000 * (copy + 1) + base
            rows.append((doc_id, " ".join(parts)))
            a, b = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (text, " ".join(parts)))
            if len(a & b) / len(a | b) >= 0.8:
                groups[base].add(doc_id)
    docs = documents(spark, rows)
    kept = {row.doc_id for row in simhash.drop_near(docs).select("doc_id").collect()}
    alone = [len(kept & group) == 1 for group in groups.values()]
    assert all(kept & group for group in groups.values())
    assert np.mean(alone) >= 0.9
    assert simhash.drop_near(docs).columns == docs.columns


def test_near_copies_of_hard_rows(spark):
    docs = documents(spark, hard_rows())
    kept = [row.doc_id for row in simhash.drop_near(docs).select("doc_id").collect()]
    assert {3, 5, 7, 9, 13} - {3} <= set(kept) and sum(n in kept for n in (2, 3, 4)) == 1
    assert simhash.drop_near(docs.filter("false")).count() == 0


def jaccards(texts):
    sets = [set(simhash.shingle_hashes(text, 5).tolist()) for text in texts]
    return {(n, m): len(sets[n] & sets[m]) / len(sets[n] | sets[m]) for n, m in itertools.combinations(range(len(sets)), 2)}


def near_rows():
    """Block edits at a similarity just above 0.8, and variants that are alike only through one base among them."""
    draw, texts = random.Random(8), []
    for base in range(40):
        parts = prose(base + 500, 300).split()
        block = prose(base + 900, 60).split()
        cut = draw.randint(20, 200)
        texts += [" ".join(part) for part in (parts, parts + block, parts[:cut] + parts[cut + 50:],
                                              parts[:cut] + block[:28] + parts[cut + 28:])]
    parts = prose(77, 400).split()
    for variant in range(40):
        other = list(parts)
        for at in draw.sample(range(5, 395, 6), 6):
            other[at] = f"v{variant}w{at}"
        texts.append(" ".join(other))
    texts.insert(len(texts) - 20, " ".join(parts))
    line = " ".join(prose(3, 12).split())
    texts += [line + " " + prose(n + 2000, draw.randint(1, 9)) for n in range(60)]
    return texts


@pytest.mark.parametrize("cold, block", [(8, 1_000_000), (2, 3_000)])
def test_near_copies_are_those_of_brute_force(spark, monkeypatch, cold, block):
    texts = near_rows()
    values = jaccards(texts)
    want = list(range(len(texts)))
    for (a, b), value in values.items():
        if value >= 0.8:
            here, there = want[a], want[b]
            want = [there if root == here else root for root in want]
    assert sum(0.8 <= value < 0.87 for value in values.values()) > 60
    monkeypatch.setattr(shingle_join, "COLD", cold)
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    known = {r.node: r.root for r in components(shingle_join.similar_links(rows, 5, 0.8, block)).collect()}
    got = [known.get(n, n) for n in range(len(texts))]
    assert [got.index(root) for root in got] == [want.index(root) for root in want]


def test_near_copies_with_block_edits_go(spark):
    rows = list(enumerate(near_rows()[:160]))
    kept = {row.doc_id for row in simhash.drop_near(documents(spark, rows)).select("doc_id").collect()}
    alike = [pair for pair, value in jaccards([text for _, text in rows]).items() if value >= 0.8]
    assert alike and not [pair for pair in alike if kept.issuperset(pair)]


def test_near_copies_come_from_fingerprints_first(spark, monkeypatch):
    seen = []

    def only_known(texts, width, similarity, known=None):
        seen.extend(known.collect())
        return known

    monkeypatch.setattr(simhash, "similar_links", only_known)
    base = [f"word{n}" for n in range(900)]
    near, far = [*base[:450], "changed", *base[451:]], [f"other{n}" for n in range(900)]
    docs = spark.createDataFrame([(n, " ".join(words)) for n, words in enumerate((base, near, far))], "doc_id long, text string")
    path = tempfile.mkdtemp(prefix="spark-") + "/docs"
    docs.coalesce(1).write.parquet(path)
    kept = [r.doc_id for r in simhash.drop_near(spark.read.parquet(path)).select("doc_id").collect()]
    assert len(seen) == 1 and sorted(kept) == [0, 2]
