"""Exact links between texts whose shingle sets are alike: a prefix-filter join, checked on the whole sets.

Shingles have one global order (frequent ones last, then by hash). Two sets with Jaccard ``t`` or more share one of the
first ``n - ceil(t * n) + 1`` shingles of each, whatever kind of edit lies between them, so only these are dealt out.
Which shingles count as frequent changes the work, never the result.

* Shingles of at most ``COLD`` texts propose all their pairs.
* Shingles of more texts propose the pairs with their first text. Those whose texts are still in several components of
  *verified* links then form blocks, and each block is compared as a whole in tasks (blocks above ``BLOCK`` shingles in
  pairs of parts), so that no unchecked candidate crosses two components and no dense group writes all its pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markfield.llm.common import settle, slices, small_side
from markfield.llm.components import components

#: Texts of a shingle up to which all its pairs are proposed.
COLD = 8
#: Frequent shingles sent to the tasks, at most; rounds in which they are looked for.
FREQUENT, ROUNDS = 1_000_000, 2
#: Shingles of a part of a block.
BLOCK = 1_000_000
BROADCAST_ROWS = 200_000
SLACK = 1e-9


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    from markfield.llm.simhash import shingle_hashes

    return np.unique(shingle_hashes(text, width).view(np.int64))


def prefix(found: np.ndarray, frequent: np.ndarray, similarity: float) -> np.ndarray:
    """The shingles of which a set of ``similarity`` or more must share one; zero stands for the empty set."""
    if not len(found):
        return np.zeros(1, np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        often = frequent[at] == found
        found = np.concatenate([found[~often], found[often]])
    return found[:len(found) - math.ceil(similarity * len(found) - SLACK) + 1]


def alike(shared: int, left: int, right: int, similarity: float) -> bool:
    return shared >= similarity * (left + right - shared) - SLACK


def prefixes(texts: DataFrame, width: int, similarity: float, frequent: np.ndarray) -> DataFrame:
    """``token, key, size``: the prefix of every text of ``key, text``."""
    sent = texts.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            sets = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            heads = [prefix(found, sent.value, similarity) for found in sets]
            counts = [len(head) for head in heads]
            yield pa.RecordBatch.from_pydict({
                "token": pa.array(np.concatenate(heads) if heads else np.empty(0, np.int64)),
                "key": pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), counts)),
                "size": pa.array(np.repeat(np.array([len(found) for found in sets], np.int32), counts))})

    return texts.mapInArrow(run, "token long, key long, size int")


def frequent_tokens(texts: DataFrame, width: int, similarity: float) -> np.ndarray:
    """Sorted shingles found in more than ``COLD`` prefixes, at most ``FREQUENT`` of them."""
    known = np.empty(0, np.int64)
    for _ in range(ROUNDS):
        often = settle(prefixes(texts, width, similarity, known).groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter(
            F.col("n") > COLD), "frequent")
        least, room = COLD, FREQUENT - len(known)
        while often.filter(F.col("n") > least).count() > room:
            least *= 2
        more = often.filter(F.col("n") > least).select("token").toArrow().column(0).to_numpy()
        new = np.union1d(known, more)
        if len(new) == len(known):
            break
        known = new
    return known


def proposals(heads: DataFrame, similarity: float) -> DataFrame:
    """``a, b, hot``: pairs of keys, and, where ``hot``, each shingle of many texts (``a``) with each of its keys (``b``)."""
    def near(one: int, other: int) -> bool:
        return min(one, other) >= similarity * max(one, other) - SLACK

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, held, hot = None, [], False
        for batch in itertools.chain(batches, [None]):
            out: list[tuple[int, int, bool]] = []
            if batch is None:
                if not hot:
                    out += [(b, a, False) for (a, n), (b, m) in itertools.combinations(held, 2) if near(n, m)]
            elif batch.num_rows:
                tokens, keys, sizes = (batch.column(n).to_numpy(zero_copy_only=False) for n in range(3))
                edges = np.concatenate([[0], np.flatnonzero(np.diff(tokens)) + 1, [len(tokens)]])
                runs = np.diff(edges) > 1
                runs[0] = runs[-1] = True
                for low, high in zip(edges[:-1][runs].tolist(), edges[1:][runs].tolist()):
                    if tokens[low] != token:
                        if not hot:
                            out += [(b, a, False) for (a, n), (b, m) in itertools.combinations(held, 2) if near(n, m)]
                        token, held, hot = int(tokens[low]), [], False
                    rows = list(zip(keys[low:high].tolist(), sizes[low:high].tolist()))
                    if not hot:
                        held += rows
                        if len(held) <= COLD:
                            continue
                        hot, rows, held = True, held, held[:1]
                        out.append((token, rows[0][0], True))
                        rows = rows[1:]
                    first, size = held[0]
                    out += [(token, key, True) for key, _ in rows]
                    out += [(key, first, False) for key, n in rows if near(n, size)]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("a", "b", "hot"), (
                    pa.array(column, kind) for column, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.bool_()))))))

    return heads.mapInArrow(run, "a long, b long, hot boolean")


def sets_of(texts: DataFrame, keys: DataFrame, width: int) -> DataFrame:
    """``key, hashes`` of the texts named by ``keys``."""
    linked = texts.join(small_side(keys, keys.count(), BROADCAST_ROWS), "key", "left_semi").select("key", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            hashes = [shingle_set(text, width) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes, pa.list_(pa.int64()))], names=["key", "hashes"])

    return settle(linked.mapInArrow(run, "key long, hashes array<long>"), "shingles")


def verified(proposed: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The proposed pairs that hold on the whole sets."""
    ends = settle(proposed.select(F.col("a").alias("key")).union(proposed.select("b")).distinct(), "ends")
    shingles = sets_of(texts, ends, width)
    left = shingles.select(F.col("key").alias("a"), F.col("hashes").alias("ha"))
    right = shingles.select(F.col("key").alias("b"), F.col("hashes").alias("hb"))
    shared = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - shared
    return proposed.join(left, "a").join(right, "b").filter(shared >= similarity * union - SLACK).select("a", "b")


def block_links(keys: list[int], groups: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that join the components of one block; ``groups`` are those known before. Every crossing pair is compared."""
    owner = {group: group for group in groups}

    def root(group: int) -> int:
        while owner[group] != group:
            owner[group] = owner[owner[group]]
            group = owner[group]
        return group

    sizes = np.array([len(found) for found in sets])
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(tokens, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(tokens))])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    links, open_groups = [], len(owner)
    for n in range(1, len(sets)):
        if open_groups == 1:
            break
        own = tokens[bounds[n]:bounds[n + 1]]
        shared = np.zeros(n, np.int64)
        for at in own.tolist():
            held = holders[starts[at]:starts[at + 1]]
            shared[held[:np.searchsorted(held, n)]] += 1
        for other in np.flatnonzero(shared >= similarity * (sizes[n] + sizes[:n] - shared) - SLACK).tolist():
            here, there = root(groups[n]), root(groups[other])
            if here != there:
                owner[here] = there
                open_groups -= 1
                links.append((keys[n], keys[other]))
    return links


def crossing_links(members: DataFrame, known: DataFrame, texts: DataFrame, width: int, similarity: float,
                   block: int = BLOCK) -> DataFrame | None:
    """Links still missing between the texts of frequent shingles ``token, key``, given the ``known`` ones."""
    roots = components(known).select(F.col("node").alias("key"), "root")
    named = settle(members.join(roots, "key", "left").select("token", "key", F.coalesce("root", "key").alias("root")), "members")
    crossing = settle(named.groupBy("token").agg(F.min("key").alias("low"), F.min("root").alias("a"), F.max("root").alias("b")).filter(
        "a <> b").select("token", "low"), "crossing")
    count = crossing.count()
    if not count:
        return None
    left = settle(named.join(small_side(crossing, count, BROADCAST_ROWS), "token").select("key", "root", "low").distinct(), "left")
    blocks = components(left.select(F.col("key").alias("a"), F.col("low").alias("b"))).withColumnRenamed("root", "block")
    keys = settle(left.select("key", "root").distinct().join(blocks.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "root", F.coalesce("block", "key").alias("block")), "block-keys")
    rows = keys.join(sets_of(texts, keys.select("key"), width), "key")
    large = settle(rows.groupBy("block").agg(F.sum(F.size("hashes")).alias("n")).select(
        "block", F.ceil(F.col("n") / block).cast("int").alias("parts")).filter("parts > 1"), "large-blocks")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    paired = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.xxhash64(
        F.col("block"), F.least(own, other), F.greatest(own, other)))
    dealt = rows.join(small_side(large, large.count(), BROADCAST_ROWS), "block", "left").withColumn(
        "shard", F.explode(F.when(F.col("parts").isNull(), F.array("block")).otherwise(paired)))

    def run(cells: pa.Table) -> pa.Table:
        cells = cells.sort_by("key").combine_chunks()
        sets = [np.array(found, np.int64) for found in cells.column("hashes").to_pylist()]
        found = block_links(cells.column("key").to_pylist(), cells.column("root").to_pylist(), sets, similarity)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return dealt.select("shard", "key", "root", "hashes").groupBy("shard").applyInArrow(run, "a long, b long")


def similar_links(texts: DataFrame, width: int, similarity: float, block: int = BLOCK, known: DataFrame | None = None) -> DataFrame:
    """Links ``a, b`` that give the components of all pairs of ``key, text`` with Jaccard >= ``similarity``.

    Pairs inside a component of ``known`` links, which hold on the whole sets, are not checked again.
    """
    heads = prefixes(texts, width, similarity, frequent_tokens(texts, width, similarity))
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = settle(proposals(heads.repartition(tasks, "token").sortWithinPartitions("token", "key"), similarity), "proposed")
    pairs = found.filter("not hot").select("a", "b").distinct()
    if known is not None:
        roots = components(known)
        for end in ("a", "b"):
            pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
        pairs = pairs.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    checked = verified(settle(pairs, "pairs"), texts, width, similarity)
    known = settle(checked if known is None else checked.union(known), "links")
    more = crossing_links(found.filter("hot").select(F.col("a").alias("token"), F.col("b").alias("key")), known, texts,
                          width, similarity, block)
    return known if more is None else settle(known.union(more), "all-links")
