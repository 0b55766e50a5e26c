"""SimHash near-duplicates through BK-trees.

Fingerprints are made in Arrow batches. Equal fingerprints become one node; nodes are dealt into shards
whose members agree on some of the bits, and every shard is one BK-tree: children are keyed by their integer
Hamming distance to the parent and a search follows only the edges within the radius of that distance. Shard
trees travel to the tasks by a shuffle on the shard key, because the whole index grows with the corpus and has
no bound to broadcast under. :func:`pigeonhole` is exact: with ``radius`` differing bits at least one choice of blocks
agrees. The number of blocks follows the counted nodes, so shards stay small; the links found are the same for any
choice. Near-copies of whole texts (:func:`drop_near`) come from such links, checked on the whole shingle sets; an exact
join (``shingle_join``) follows for pairs that fingerprints miss.

A shard gives only links that join what is not yet joined inside it (and, on request, each member's nearest),
so a dense group gives rows in proportion to its members. Shards above ``SHARD`` members are parted, and every pair
of parts is searched, so no task holds more than two parts.

Null text counts as empty and has fingerprint zero; repeated rows and null identifiers are kept; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import random
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import parts_for, settle, slices, small_side, table, whole
from markfield.llm.components import components
from markfield.llm.exact_dedup import located
from markfield.llm.shingle_join import similar_links, verified

RADIUS = 4
SHARD = 20_000
#: Members a shard should have on average; the pigeonhole blocks are chosen for it.
SHARD_MEAN = 64
#: Small key tables are broadcast up to this counted number of rows, else shuffled.
BROADCAST_ROWS = 200_000
#: Odd constants of a published 64-bit mixer.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
Mask = tuple[int, ...]


# ------------------------------------------------------------------ fingerprints

def shingle_hashes(text: str, width: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``width`` words (A-Z lower-cased, ASCII white space); fewer words: the whole run."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - width, 0)
    spans = zip(starts[:last + 1].tolist(), ends[min(width, len(words)) - 1:].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, last + 1)


def mixed(hashes: np.ndarray, copy: int) -> np.ndarray:
    """Independent 64-bit hashes from given ones; copy 0 is the hashes themselves."""
    if not copy:
        return hashes
    with np.errstate(over="ignore"):
        h = hashes + np.uint64((MIX[0] * copy) & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[1])
        h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[2])
    return h ^ (h >> np.uint64(31))


def majority(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """The 64 bits set in over half of the hashes, as a signed number."""
    counts = np.zeros(64, np.int64)
    for low in range(0, len(hashes), block):
        part = np.ascontiguousarray(hashes[low:low + block])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, carry: Sequence[str], text_col: str = "text", *,
                 recipes: Sequence[tuple[str, int, int, bool]] = (("fp", 4, 1, False),)) -> DataFrame:
    """``key``, the ``carry`` columns and one array of longs per recipe (name, words, copies of 64 bits, distinct).

    ``key`` is unique per row of the result's table in the shared folder.
    """
    rows = docs.select(*carry, whole(text_col).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = itertools.count(TaskContext.get().partitionId() << 36)
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            found: list[list[list[int]]] = [[] for _ in recipes]
            for text in batch.column(len(carry)).to_pylist():
                for out, (_, width, copies, distinct) in zip(found, recipes):
                    hashes = shingle_hashes(text, width)
                    hashes = np.unique(hashes) if distinct else hashes
                    out.append([majority(mixed(hashes, copy)) for copy in range(copies)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(itertools.islice(serial, batch.num_rows)), pa.int64()), *batch.columns[:len(carry)],
                 *(pa.array(out, pa.list_(pa.int64())) for out in found)],
                names=["key", *carry, *(recipe[0] for recipe in recipes)])

    kinds = [f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields[:-1]]
    schema = ", ".join(["key long", *kinds, *(f"{recipe[0]} array<long>" for recipe in recipes)])
    return settle(rows.mapInArrow(run, schema), "fingerprints")


# ------------------------------------------------------------------ shards

def pigeonhole(radius: int, nodes: int, bits: int = 64, mean: int = SHARD_MEAN) -> list[Mask]:
    """Choices of bit blocks of which one agrees whenever at most ``radius`` bits differ."""
    for blocks in range(radius + 1, bits + 1):
        edges = [bits * n // blocks for n in range(blocks + 1)]
        block = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
        keep = blocks - radius
        if nodes >> (keep * (bits // blocks)) <= mean or keep > 5:
            return [_words(sum(chosen), bits) for chosen in itertools.combinations(block, keep)]
    raise ValueError("radius must be below the number of bits")


def _words(mask: int, bits: int) -> Mask:
    signed = lambda word: word - (1 << 64) if word >> 63 else word
    return tuple(signed(mask >> 64 * n & (1 << 64) - 1) for n in range((bits + 63) // 64))


def _shard_keys(masks: Sequence[Mask], fp: str) -> Column:
    return F.array(*(F.xxhash64(F.lit(number), *(F.col(fp)[n].bitwiseAND(F.lit(word)) for n, word in enumerate(mask)))
                     for number, mask in enumerate(masks)))


def routed(nodes: DataFrame, masks: Sequence[Mask], shard: int = SHARD) -> DataFrame:
    """``nodes`` repeated per shard key; shards above ``shard`` members are parted, one key per pair of parts."""
    dealt = nodes.withColumn("shard", F.explode(_shard_keys(masks, "fp")))
    large = settle(dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > shard),
                   "large-shards")
    known = large.count()
    if not known:
        return dealt
    large = large.select("shard", F.ceil(F.col("members") / shard).cast("int").alias("parts"))
    split = dealt.join(small_side(large, known, BROADCAST_ROWS), "shard", "left")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    paired = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.xxhash64(
        F.col("shard"), F.least(own, other), F.greatest(own, other)))
    keys = F.when(F.col("parts").isNull(), F.array("shard")).otherwise(paired)
    return split.withColumn("shard", F.explode(keys)).drop("parts")


class BKTree:
    """Whole numbers under Hamming distance; equal numbers share a place."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.members: list[list[int]] = []

    def add(self, value: int, member: int) -> None:
        if not self.values:
            self._grow(value, member)
            return
        at = 0
        while distance := (self.values[at] ^ value).bit_count():
            below = self.children[at].get(distance)
            if below is None:
                self.children[at][distance] = len(self.values)
                self._grow(value, member)
                return
            at = below
        self.members[at].append(member)

    def _grow(self, value: int, member: int) -> None:
        self.values.append(value)
        self.children.append({})
        self.members.append([member])

    def within(self, value: int, radius: int) -> list[int]:
        """Members at most ``radius`` away."""
        if not self.values:
            return []
        found, values, children, todo = [], self.values, self.children, [0]
        while todo:
            at = todo.pop()
            distance = (values[at] ^ value).bit_count()
            if distance <= radius:
                found += self.members[at]
            if children[at]:
                low, high = distance - radius, distance + radius
                todo += [child for edge, child in children[at].items() if low <= edge <= high]
        return found


def shard_links(values: Sequence[int], radius: int, checks: Sequence[int] | None = None, check_radius: int = 0,
                nearest: int = 0) -> list[tuple[int, int]]:
    """Links inside one shard that join its components, and each member's ``nearest`` earlier ones.

    With ``checks``, a pair counts only if those are at most ``check_radius`` apart too.
    """
    tree, owner, links = BKTree(), list(range(len(values))), []

    def root(n: int) -> int:
        while owner[n] != n:
            owner[n] = owner[owner[n]]
            n = owner[n]
        return n

    for n, value in enumerate(values):
        hits = tree.within(value, radius)
        if checks is not None and hits:
            ranked = sorted(((checks[n] ^ checks[hit]).bit_count(), hit) for hit in hits)
            hits = [hit for distance, hit in ranked if distance <= check_radius]
        for rank, hit in enumerate(hits):
            here, there = root(n), root(hit)
            if here != there or rank < nearest:
                owner[here] = there
                links.append((n, hit))
        tree.add(value, n)
    return links


def links(nodes: DataFrame, radius: int, masks: Sequence[Mask], *, shard: int = SHARD, check: str | None = None,
          check_radius: int = 0, nearest: int = 0) -> DataFrame:
    """Links ``a, b`` between the keys of ``nodes(key, fp[, check])``, found shard by shard in BK-trees."""
    columns = ["shard", "key", "fp", *([check] if check else [])]
    dealt = routed(nodes.select(*columns[1:]), masks, shard).select(*columns)
    tasks = parts_for(nodes.count() * len(masks), 250_000)
    tasks = max(tasks, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.repartition(tasks, "shard").sortWithinPartitions("shard", "key")

    def numbers(cells: pa.Array) -> np.ndarray:
        flat = cells.flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(cells), -1) if len(cells) else np.empty((0, 1), np.int64)

    def whole_numbers(words: np.ndarray) -> list[int]:
        if words.shape[1] == 1:
            return words[:, 0].astype(np.uint64).tolist()
        return [int.from_bytes(row.tobytes(), "little") for row in np.ascontiguousarray(words)]

    def found(keys: list[np.ndarray], cells: list[np.ndarray], more: list[np.ndarray]) -> tuple[list[int], list[int]]:
        names = np.concatenate(keys).tolist()
        checks = whole_numbers(np.concatenate(more)) if check else None
        pairs = shard_links(whole_numbers(np.concatenate(cells)), radius, checks, check_radius, nearest)
        return [names[a] for a, _ in pairs], [names[b] for _, b in pairs]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard_now, held, rows = None, ([], [], []), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shards, keys = (batch.column(n).to_numpy(zero_copy_only=False) for n in (0, 1))
            cells = numbers(batch.column(2))
            more = numbers(batch.column(3)) if check else cells
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            left: list[int] = []
            right: list[int] = []
            for low, high in zip(edges, edges[1:]):
                if shards[low] != shard_now:
                    if rows > 1:
                        a, b = found(*held)
                        left += a
                        right += b
                    shard_now, held, rows = shards[low], ([], [], []), 0
                for part, column in zip(held, (keys, cells, more)):
                    part.append(column[low:high])
                rows += high - low
            yield pa.RecordBatch.from_pydict({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})
        if rows > 1:
            a, b = found(*held)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.mapInArrow(run, "a long, b long")


# ------------------------------------------------------------------ classes and near-duplicates

def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
            shard: int = SHARD) -> DataFrame:
    """``id, fp, component`` of every row: its 64-bit fingerprint and the least id reachable over links."""
    rows = fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id"]).select(
        "id", F.col("fp")[0].alias("fp"))
    nodes = settle(rows.groupBy("fp").agg(F.min("id").alias("low")), "nodes")
    found = links(nodes.select(F.col("fp").alias("key"), F.array("fp").alias("fp")), radius,
                  pigeonhole(radius, nodes.count()), shard=shard)
    rooted = nodes.join(components(found).withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.select("fp", "root").join(lowest, "root").select("fp", "component")
    return rows.join(named, "fp", "left").select("id", "fp", "component")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


WIDTH, SIMILARITY = 5, 0.8


def fingerprint_links(texts: DataFrame, width: int, similarity: float, radius: int = RADIUS) -> DataFrame:
    """``a, b`` of ``key, text``: links of fingerprints over shingle sets, found in BK-trees, that hold on the whole sets."""
    rows = fingerprints(texts.withColumnRenamed("key", "id"), ["id"], recipes=(("fp", width, 1, True),)).select(
        "id", F.col("fp")[0].alias("fp"))
    nodes = settle(rows.groupBy("fp").agg(F.min("id").alias("low")), "nodes")
    near = links(nodes.select(F.col("low").alias("key"), F.array("fp").alias("fp")), radius, pigeonhole(radius, nodes.count()))
    equal = rows.join(nodes, "fp").filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b"))
    return settle(verified(settle(near.union(equal).distinct(), "fingerprint-pairs"), texts, width, similarity), "fingerprint-links")


def near_links(rows: DataFrame, text_col: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """``key, file, row`` of located documents, and links that give the components of all pairs whose five-word
    shingle sets have Jaccard >= ``similarity``.

    Texts whose fingerprints link are compared first. Fingerprints miss some pairs (a block edit changes far more bits
    than scattered words); these are found by an exact join, which leaves out what the first links have united.
    """
    files = settle(rows.select("file").distinct().coalesce(1).withColumn("number", F.monotonically_increasing_id()), "files")
    keyed = rows.join(small_side(files, files.count(), BROADCAST_ROWS), "file")
    key = F.shiftleft("number", 40).bitwiseOR(F.col("row")).alias("key")
    texts = keyed.select(key, whole(F.col("doc").getField(text_col)).alias("text"))
    return keyed.select(key, "file", "row"), similar_links(texts, WIDTH, similarity, known=fingerprint_links(texts, WIDTH, similarity))


def drop_near(docs: DataFrame, text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one read first. Texts without words are one group."""
    rows = located(docs)
    prints, found = near_links(rows, text_col, similarity)
    rest = components(found).join(prints.select(F.col("key").alias("node"), "file", "row"), "node")
    rest = settle(rest.select("file", "row"), "near-copies")
    return rows.join(small_side(rest, rest.count(), BROADCAST_ROWS), ["file", "row"], "left_anti").select("doc.*")
