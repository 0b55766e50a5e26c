"""The prefix trie of conversations, built by bursting.

Turns become ids of 128 bits of a digest of role and text; texts go no further. Equal sequences of turns are one row
with a count before anything else, combined before the shuffle. At first the root's container holds all sequences.
A container of more than ``CONTAINER`` sequences bursts: it becomes a trie head and its sequences move on to the
containers of their next turn id. What then remains is dealt out by head, sorted, and swept: a stack holds the path of
the current sequence, and a node is complete when the sweep leaves it. The heads get their totals from their children,
deepest level first.

A container has at most ``CONTAINER`` distinct sequences, a burst takes one round of two jobs over the sequences of
the containers that burst only, and rounds end where fewer share a beginning. One conversation's ids (16 bytes a turn)
pass through one task; its texts do not. Members that end at a node are hashed from stretches of ``STRETCH``
identifiers, so a group of copies sends one row per stretch.

Null roles and texts are empty; turns are ordered by number, null first, then role and text; repeated rows are turns
of their own; rows without ``conv_id`` belong to no conversation; negative identifiers take the remainder that is not
negative; other columns are ignored; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.chat import turns
from markfield.llm.common import CRC_SQL, crc32_sql, settle, small_side, table

#: Distinct sequences a container may hold before it bursts.
CONTAINER = 1_000
STRETCH = 4_096
BROADCAST_ROWS = 200_000
#: Conversations are rebuilt in families of so many; fewer than HEADS turns come from the family's first.
FAMILY, HEADS = 5, 9
NODE = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
SWEPT = ("conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, parent_conv_id long, "
         "ends binary, head binary, parent binary, partial boolean")


def digest(*parts: Column) -> Column:
    """128 bits of a digest of columns in a row."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turn_ids(rows: DataFrame) -> DataFrame:
    """``conv, pos, id, bytes`` of every turn of a conversation, in the shared folder."""
    numbered = turns(rows.filter("conv_id is not null"), lambda text: F.lit(0))
    return settle(numbered.select("conv", "pos", digest(F.length("role").cast("string"), F.lit(":"), "role", "text").alias("id"),
                                  F.octet_length("text").cast("long").alias("bytes")), "turn-ids")


def rebuilt(told: DataFrame) -> DataFrame:
    """``conv, pos, id, bytes``: conversations that begin with turns of their family's first; turnless ones have one null turn."""
    def borrowed(conv: str) -> Column:
        return F.crc32(F.col(conv).cast("string")) % HEADS

    convs = told.select("conv").distinct()
    asked = convs.select(F.col("conv").alias("c"), (F.col("conv") - F.pmod("conv", F.lit(FAMILY))).alias("conv"), borrowed("conv").alias("h"))
    first = told.filter(F.col("pos") < HEADS - 1).join(asked.hint("merge"), "conv").filter("pos < h").select(
        F.col("c").alias("conv"), "pos", "id", "bytes")
    own = told.filter(F.col("pos") >= borrowed("conv"))
    none = convs.select("conv", *(F.lit(None).cast(told.schema[name].dataType).alias(name) for name in ("pos", "id", "bytes")))
    return own.unionByName(first).unionByName(none)


def sequences(rows: DataFrame) -> DataFrame:
    """``conv, key, ids, sizes``: a conversation's turn ids and bytes in order, and a digest of the whole, in the shared folder."""
    lists = rows.groupBy("conv").agg(F.array_sort(F.collect_list(
        F.when(F.col("pos").isNotNull(), F.struct("pos", "id", "bytes")))).alias("told"))
    parts = lists.select("conv", F.transform("told", lambda turn: turn["id"]).alias("ids"),
                         F.transform("told", lambda turn: turn["bytes"]).alias("sizes"))
    return settle(parts.withColumn("key", F.unhex(F.sha2(F.array_join(F.transform("ids", F.hex), ""), 256))), "sequences")


# ------------------------------------------------------------------ members that end together

def ends(rows: DataFrame) -> DataFrame:
    """``ends, ends_sha256``: per key of ``conv, key``, the digest of its ascending identifiers, joined by commas."""
    stretches = rows.groupBy("key", F.floor(F.col("conv") / STRETCH).alias("stretch")).agg(
        F.array_join(F.array_sort(F.collect_list("conv")).cast("array<string>"), ",").alias("told"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for now, told in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if now != key:
                    done += [(key, state.hexdigest())] if key is not None else []
                    key, state = now, hashlib.sha256(told.encode())
                else:
                    state.update(f",{told}".encode())
            yield _hashed(done)
        if key is not None:
            yield _hashed([(key, state.hexdigest())])

    dealt = stretches.repartition("key").sortWithinPartitions("key", "stretch").select("key", "told")
    return dealt.mapInArrow(run, "ends binary, ends_sha256 string")


def _hashed(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key for key, _ in done], pa.binary()), pa.array([told for _, told in done], pa.string())],
                                      names=["ends", "ends_sha256"])


# ------------------------------------------------------------------ bursting

def burst(rows: DataFrame, container: int = CONTAINER) -> tuple[DataFrame, list[DataFrame]]:
    """Containers of ``key, ids, sizes, n, first`` as ``head, parent, base, partial`` beside them, and the heads that burst, by level."""
    no_head = F.lit(None).cast("binary")
    active = rows.withColumns({"head": F.lit(b""), "parent": no_head, "base": F.lit(0)})
    kept, levels = [], []
    while True:
        big = active.groupBy("head").agg(
            F.count(F.lit(1)).alias("_n"), F.first("parent").alias("parent"),
            F.first(F.when(F.col("base") > 0, F.get("sizes", F.col("base") - 1)).otherwise(0)).alias("bytes"))
        big = settle(big.filter(F.col("_n") > container).drop("_n"), "burst-heads")
        number = big.count()
        if not number:
            kept.append(active.withColumn("partial", F.lit(False)))
            break
        marks = small_side(big.select("head", F.lit(True).alias("partial")), number, BROADCAST_ROWS)
        marked = settle(active.join(marks, "head", "left").withColumn("partial", F.coalesce("partial", F.lit(False))), "containers")
        onward = F.col("partial") & (F.size("ids") > F.col("base"))
        kept.append(marked.filter(~onward))
        active = marked.filter(onward).drop("partial").withColumns({
            "parent": F.col("head"), "head": digest("head", F.element_at("ids", F.col("base") + 1)), "base": F.col("base") + 1})
        levels.append(big)
    found = kept[0]
    for more in kept[1:]:
        found = found.unionByName(more)
    return found, levels


class _Node:
    __slots__ = ("bytes", "children", "depth", "ends", "first", "held", "leaves", "n", "saved")

    def __init__(self, depth: int, size: int) -> None:
        self.depth, self.bytes = depth, size
        self.n = self.children = self.leaves = self.saved = 0
        self.first: int | None = None
        self.ends: bytes | None = None
        self.held: list[_Node] = []

    def gather(self, n: int, first: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(self.first, first)

    def close(self) -> list[tuple]:
        """Complete this node; the rows of its children, whose parent it is."""
        self.leaves = self.leaves if self.children else 1
        self.saved += (self.n - 1) * self.bytes
        rows = [(*child.row(), self.first, child.ends, None, None, None) for child in self.held]
        self.held = []
        return rows

    def row(self) -> tuple:
        return self.first, self.depth, self.n, self.children, self.leaves, self.saved

    def take(self, child: _Node) -> None:
        self.gather(child.n, child.first)
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved
        self.held.append(child)


def sweep(containers: DataFrame) -> DataFrame:
    """Rows of :data:`SWEPT`: every node below a container's head, and the head itself with its ``head`` and ``parent``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Node] = []
        path: list[bytes] = []
        head: tuple = ()
        rows: list[tuple] = []

        def leave(depth: int) -> None:
            while len(stack) > depth:
                node = stack.pop()
                rows.extend(node.close())
                if stack:
                    stack[-1].take(node)
                else:
                    rows.append((*node.row(), None, node.ends, *head))

        for batch in batches:
            for key, ids, sizes, n, first, at, parent, base, partial in zip(*(column.to_pylist() for column in batch.columns)):
                if not stack or (at, partial) != (head[0], head[2]):
                    leave(0)
                    head, path = (at, parent, partial), []
                    stack.append(_Node(base, sizes[base - 1] if base else 0))
                ids, sizes = ids[base:], sizes[base:]
                shared = 0
                while shared < min(len(path), len(ids)) and path[shared] == ids[shared]:
                    shared += 1
                leave(shared + 1)
                stack.extend(_Node(base + level + 1, sizes[level]) for level in range(shared, len(ids)))
                stack[-1].gather(n, first)
                stack[-1].ends = key
                path = ids
                if len(rows) > 4_096:
                    yield _swept(rows)
                    rows.clear()
        leave(0)
        if rows:
            yield _swept(rows)

    columns = ["key", "ids", "sizes", "n", "first", "head", "parent", "base", "partial"]
    dealt = containers.select(*columns).repartition("head").sortWithinPartitions("head", "ids")
    return settle(dealt.mapInArrow(run, SWEPT), "swept")


def _swept(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary()] * 3 + [pa.bool_()]
    names = [part.split(" ")[0] for part in SWEPT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(cells, kind) for cells, kind in zip(zip(*rows), kinds)], names=names)


def heads(swept: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Finished rows of the containers' heads and of the heads that burst: totals upwards, then the parents' names."""
    tops = swept.filter("head is not null")
    columns = [*NODE, "ends", "head", "parent"]
    done = [tops.filter("not partial").select(*columns)]
    below = done[0].filter(F.col("depth") == len(levels))
    for depth in range(len(levels) - 1, -1, -1):
        totals = below.groupBy(F.col("parent").alias("head")).agg(
            F.min("conv_id").alias("least"), F.sum("n_convs").alias("n"), F.count(F.lit(1)).alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        ended = tops.filter(F.col("partial") & (F.col("depth") == depth)).select("head", "ends", "n_convs", "conv_id")
        joined = levels[depth].join(totals, "head").join(ended, "head", "left").select(
            "head", "parent", "ends", F.least("conv_id", "least").alias("conv_id"), F.lit(depth).cast("long").alias("depth"),
            (F.col("n") + F.coalesce("n_convs", F.lit(0))).alias("n_convs"), "n_children", "n_leaves", "saved", "bytes")
        node = joined.withColumn("saved_tokens", F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")).select(*columns)
        done.append(settle(node, "head-nodes"))
        below = done[-1].unionByName(done[0].filter(F.col("depth") == depth))
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    named = done[1:]
    if not named:
        return found.withColumn("parent_conv_id", F.lit(None).cast("long"))
    names = named[0]
    for more in named[1:]:
        names = names.unionByName(more)
    names = names.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return found.join(small_side(names, names.count(), BROADCAST_ROWS), "parent", "left")


def trie(rows: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per node of the trie of ``conv_id, turn, role, text``; see the module's contract."""
    told = sequences(rebuilt(turn_ids(rows)))
    distinct = settle(told.groupBy("key").agg(
        F.first("ids").alias("ids"), F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("first")), "distinct")
    containers, levels = burst(distinct, container)
    swept = sweep(containers)
    columns = [*NODE, "parent_conv_id", "ends"]
    nodes = swept.filter("head is null").select(*columns).unionByName(heads(swept, levels).select(*columns))
    hashed = nodes.filter("ends is not null").join(ends(told).hint("merge"), "ends").drop("ends")
    through = nodes.filter("ends is null").drop("ends").withColumn("ends_sha256", F.sha2(F.lit(""), 256))
    return hashed.unionByName(through).select("conv_id", "depth", "parent_conv_id", *NODE[2:], "ends_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


SQL = f"""
WITH RECURSIVE {CRC_SQL},
told AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    octet_length(encode(coalesce(text, ''))) AS size FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c::VARCHAR AS name FROM (SELECT DISTINCT c FROM told)),
asked AS (SELECT c, {crc32_sql('name')} % {HEADS} AS h FROM convs, crc),
again AS (SELECT asked.c, pos, id, size FROM asked JOIN told ON told.c = asked.c AND pos >= h
  UNION ALL SELECT asked.c, pos, id, size FROM asked JOIN told
    ON told.c = asked.c - (asked.c % {FAMILY} + {FAMILY}) % {FAMILY} AND pos < h),
lists AS (SELECT c, list(id ORDER BY pos) FILTER (pos IS NOT NULL) AS ids, list(size ORDER BY pos) FILTER (pos IS NOT NULL) AS sizes
    FROM asked LEFT JOIN again USING (c) GROUP BY c),
spans AS (SELECT *, unnest(range(coalesce(len(ids), 0) + 1)) AS depth FROM lists),
paths AS (SELECT c, depth, depth = coalesce(len(ids), 0) AS is_end, CASE WHEN depth > 0 THEN sizes[depth] ELSE 0 END AS size,
    CASE WHEN depth > 0 THEN array_to_string(ids[1:depth], ',') ELSE '' END AS node,
    CASE WHEN depth > 1 THEN array_to_string(ids[1:depth - 1], ',') WHEN depth = 1 THEN '' END AS parent FROM spans),
nodes AS (SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256 FROM paths GROUP BY node),
children AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
over_ AS (SELECT DISTINCT above.node AS top, below.node FROM paths above JOIN paths below ON above.c = below.c AND above.depth <= below.depth),
sums AS (SELECT top AS node, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens
    FROM over_ JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY top)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
    coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""
