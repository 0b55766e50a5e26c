"""How many points lie below and left of given corners: offline dominance counting over groups of any size.

``dominated`` answers, for every asked corner ``x, y`` of a key, how many points of the key have a smaller ``x``, a
smaller ``y``, and both; a point may stand for several (``weight``). Keys of at most ``limit`` points are packed into tasks, where a merge-sort tree (sorted blocks
of every power of two) counts for all asks at once: a prefix of the ``x`` order is one block per bit, and each block one
binary search.

Larger keys go to rank space first: a range partitioning by ``x``, then one by ``y``, running counts inside the
partitions and the partitions' totals before them. Ranks have no ties, so equal-sized blocks of ranks always exist. The
points below a corner are those of earlier column blocks and earlier row blocks (a table of prefix sums over at most
1,000 x 1,000 blocks), those of the corner's own row block in earlier column blocks, and those of its own column block:
two groups of one block each. Every row moves a fixed number of times; no pairs of points or tiles are made.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from markfield.operators.skew import BROADCAST_KEYS, hot_keys, settle

LIMIT = 100_000
#: Blocks of ranks per side, at most.
BLOCKS = 1_000
FOUND = ["total", "below_x", "below_y", "below"]


# ------------------------------------------------------------------ inside a task

class Prefixes:
    """Weights of values below a bound among the first k of a sequence."""

    def __init__(self, values: np.ndarray, weights: np.ndarray | None = None) -> None:
        weights = np.ones(len(values), np.int64) if weights is None else weights
        self.span = int(values.max(initial=0)) + 2
        size = 1 << max(len(values) - 1, 0).bit_length()
        keys = np.concatenate([values, np.full(size - len(values), self.span - 1)]).astype(np.int64)
        weights = np.concatenate([weights, np.zeros(size - len(values), np.int64)])
        self.levels = []
        while True:
            width = 1 << len(self.levels)
            lifted = keys + np.repeat(np.arange(size // width), width) * self.span
            order = np.argsort(lifted, kind="stable")
            keys, weights = keys[order], weights[order]
            self.levels.append((lifted[order], np.concatenate([[0], np.cumsum(weights)])))
            if width >= size:
                break

    def below(self, first: np.ndarray, bound: np.ndarray) -> np.ndarray:
        found = np.zeros(len(first), np.int64)
        bound = np.minimum(bound, self.span - 1)
        for level, (keys, sums) in enumerate(self.levels):
            some = np.flatnonzero(first >> level & 1)
            block = (first[some] >> (level + 1)) << 1
            found[some] += sums[np.searchsorted(keys, block * self.span + bound[some])] - sums[block << level]
        return found


def ranked(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Both columns as whole numbers in their common order, and how many there are."""
    known, codes = np.unique(np.concatenate([one, other]), return_inverse=True)
    return codes[:len(one)], codes[len(one):], len(known)


def counted(keys: np.ndarray, x: np.ndarray, y: np.ndarray, weights: np.ndarray, ask_keys: np.ndarray, ask_x: np.ndarray,
            ask_y: np.ndarray) -> tuple[np.ndarray, ...]:
    """Total, below in x, below in y and below in both for every ask; keys are whole numbers."""
    def places(own: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        codes, bounds, span = ranked(own, asked)
        key = keys * span + codes
        order = np.argsort(key, kind="stable")
        return order, np.searchsorted(key[order], ask_keys * span), np.searchsorted(key[order], ask_keys * span + bounds), codes

    order, start, end_x, _ = places(x, ask_x)
    order_y, _, end_y, codes = places(y, ask_y)
    bounds = ranked(y, ask_y)[1]
    tree = Prefixes(codes[order], weights[order])
    both = tree.below(end_x, bounds) - tree.below(start, bounds)
    after = np.searchsorted(keys[order], ask_keys, side="right")
    # A key's points start at the same place in both orders, and so do the sums before them.
    by_x, by_y = (np.concatenate([[0], np.cumsum(weights[at])]) for at in (order, order_y))
    return by_x[after] - by_x[start], by_x[end_x] - by_x[start], by_y[end_y] - by_y[start], both


# ------------------------------------------------------------------ keys that fit a task

def _packed(points: DataFrame, asks: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """``ask`` and :data:`FOUND` where no key has more than about ``limit`` points; asks of a key may be many."""
    keys = list(keys)
    rows = points.count() + asks.count()
    buckets = max(1, -(-rows // (4 * limit)))
    crowded = settle(hot_keys(asks, keys, 8 * limit), "asked_keys")
    number = crowded.count()
    names = F.concat_ws("\x1f", *(F.coalesce(F.col(key).cast("string"), F.lit("\x00")) for key in keys))
    left, right = points.withColumn("key", names), asks.withColumn("key", names)
    if number:
        fan = crowded.select(names.alias("key"), "_fan")
        fan = F.broadcast(fan) if number <= BROADCAST_KEYS else fan.hint("merge")
        left = left.join(fan, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1)))
        right = right.join(fan, "key", "left").withColumn("part", F.pmod(F.xxhash64("ask"), F.coalesce("_fan", F.lit(1))).cast("int"))
    else:
        left, right = left.withColumn("part", F.lit(0)), right.withColumn("part", F.lit(0))
    bucket = F.pmod(F.xxhash64("key", "part"), F.lit(buckets)).cast("int")
    place = F.concat_ws("\x1e", "key", "part")
    left = left.select(bucket.alias("p_bucket"), place.alias("p_key"), F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"),
                       "weight")
    right = right.select(bucket.alias("bucket"), place.alias("key"), "ask", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))

    def count(given: pa.Table, asked: pa.Table) -> pa.Table:
        together = pa.chunked_array([*given.column("p_key").chunks, *asked.column("key").chunks], pa.string()).dictionary_encode()
        codes = np.concatenate([chunk.indices.to_numpy() for chunk in together.unify_dictionaries().chunks] or [np.zeros(0)]).astype(np.int64)
        found = counted(codes[:len(given)], given.column("px").to_numpy(), given.column("py").to_numpy(), given.column("weight").to_numpy(),
                        codes[len(given):], asked.column("x").to_numpy(), asked.column("y").to_numpy())
        return pa.table({"ask": asked.column("ask"), **dict(zip(FOUND, found))})

    return right.groupBy("bucket").cogroup(left.groupBy("p_bucket")).applyInArrow(
        lambda asked, given: count(given, asked), "ask bigint, " + ", ".join(f"{name} bigint" for name in FOUND))


# ------------------------------------------------------------------ ranks of large keys

def _with_ranks(events: DataFrame, keys: Sequence[str], value: str, rank: str) -> DataFrame:
    """``events`` with how many points of their key come before them by ``value``; an ask (0 points) stands before equal points."""
    keys = list(keys)
    order = [*keys, value, "point", "no"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in events.schema.fields), "_part bigint", "_local bigint"])
    at_keys = [events.columns.index(key) for key in keys]
    at_point = events.columns.index("point")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n) for n in at_keys]
            codes = [np.asarray(column.dictionary_encode().indices.fill_null(-1)) for column in columns]
            new = np.concatenate([[False], np.any([np.diff(code) != 0 for code in codes], axis=0)])
            first = tuple(column[0].as_py() for column in columns)
            before = before if first == last else 0
            point = np.asarray(batch.column(at_point)).astype(np.int64)
            sums = np.cumsum(point) - point
            group = np.cumsum(new)
            starts = np.concatenate([[0], np.flatnonzero(new)])
            local = sums - sums[starts][group] + np.where(group == 0, before, 0)
            before, last = int(local[-1] + point[-1]), tuple(column[-1].as_py() for column in columns)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(local)],
                                             names=[*batch.schema.names, "_part", "_local"])

    ranged = events.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = settle(ranged.mapInArrow(run, schema), "local_ranks")
    totals = rows.groupBy(*keys, "_part").agg(F.sum("point").alias("_n"))
    earlier = totals.withColumn("_before", F.sum("_n").over(W.partitionBy(*keys).orderBy("_part")) - F.col("_n"))
    earlier = settle(earlier.drop("_n"), "rank_bases")
    known = F.broadcast(earlier) if earlier.count() <= BROADCAST_KEYS else earlier.hint("merge")
    return rows.join(known, [*keys, "_part"]).withColumn(rank, F.col("_local") + F.col("_before")).drop("_part", "_local", "_before")


def _corners(points: DataFrame, asks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, bx, by, base``: points in earlier column blocks and earlier row blocks, for every asked pair of blocks."""
    keys = list(keys)
    cells = points.groupBy(*keys, "bx", "by").agg(F.sum("point").alias("n"))
    cells = cells.select(*(F.col(key).alias(f"p_{key}") for key in keys), F.col("bx").alias("px"), F.col("by").alias("py"), "n")
    asked = asks.select(*keys, "bx", "by").distinct()

    def sums(told: pa.Table, given: pa.Table) -> pa.Table:
        bx, by = told.column("bx").to_numpy(), told.column("by").to_numpy()
        px, py = given.column("px").to_numpy(), given.column("py").to_numpy()
        table = np.zeros((max(bx.max(initial=0), px.max(initial=0)) + 2, max(by.max(initial=0), py.max(initial=0)) + 2), np.int64)
        np.add.at(table, (px + 1, py + 1), given.column("n").to_numpy())
        table = table.cumsum(0).cumsum(1)
        return told.append_column("base", pa.array(table[bx, by]))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields)
    return asked.groupBy(*keys).cogroup(cells.groupBy(*(f"p_{key}" for key in keys))).applyInArrow(sums, f"{kinds}, base bigint")


def _by_ranks(points: DataFrame, asks: DataFrame, keys: Sequence[str], sizes: DataFrame, limit: int) -> DataFrame:
    keys = list(keys)
    block = F.greatest(F.lit(limit), F.ceil(F.col("total") / BLOCKS)).cast("bigint")
    events = points.select(*keys, "x", "y", F.col("weight").alias("point"), F.monotonically_increasing_id().alias("no")).unionByName(
        asks.select(*keys, "x", "y", F.lit(0).cast("bigint").alias("point"), F.col("ask").alias("no")))
    placed = _with_ranks(_with_ranks(events, keys, "x", "rx"), keys, "y", "ry").drop("x", "y")
    placed = placed.join(sizes, keys).withColumn("_block", block)
    placed = settle(placed.withColumns({"bx": F.floor(F.col("rx") / F.col("_block")), "by": F.floor(F.col("ry") / F.col("_block"))}), "ranks")
    given, asked = placed.filter("point > 0"), placed.filter("point = 0").withColumnRenamed("no", "ask")

    def inside(rows: DataFrame, own: str, x: str) -> DataFrame:
        return rows.select(*keys, F.col(own).alias("_own"), F.col(x).alias("x"), F.col("ry").alias("y"), "ask" if "ask" in rows.columns else F.col("point").alias("weight"))

    parts = [_packed(inside(given, own, x), inside(asked, own, x), [*keys, "_own"], limit).select("ask", "below")
             for own, x in (("bx", "rx"), ("by", "bx"))]
    bases = settle(_corners(given, asked, keys), "corner_sums")
    base = asked.select(*keys, "bx", "by", "ask").join(
        F.broadcast(bases) if bases.count() <= BROADCAST_KEYS else bases.hint("merge"), [*keys, "bx", "by"]).select("ask", F.col("base").alias("below"))
    both = parts[0].unionByName(parts[1]).unionByName(base).groupBy("ask").agg(F.sum("below").alias("below"))
    return asked.select("ask", "total", F.col("rx").alias("below_x"), F.col("ry").alias("below_y")).join(both.hint("merge"), "ask").select(
        "ask", *FOUND)


def dominated(points: DataFrame, asks: DataFrame, keys: Sequence[str], *, limit: int = LIMIT) -> DataFrame:
    """``ask, total, below_x, below_y, below`` of every row of ``asks`` (``keys, ask, x, y``) among ``points`` (``keys, x, y``
    and, where a row stands for several points, their number ``weight``).

    Keys are not null, ``ask`` is a distinct whole number; corners may be infinite. Both tables are read several times,
    so they should be settled. ``limit`` changes the work, never the result.
    """
    keys = list(keys)
    if "weight" not in points.columns:
        points = points.withColumn("weight", F.lit(1).cast("bigint"))
    large = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("total")).filter(F.col("rows") > limit)
    large = settle(large.drop("rows"), "large_keys")
    number = large.count()
    if not number:
        return _packed(points, asks, keys, limit)
    marks = large.select(*keys)
    marks = F.broadcast(marks) if number <= BROADCAST_KEYS else marks.hint("merge")
    sizes = F.broadcast(large) if number <= BROADCAST_KEYS else large.hint("merge")
    few = _packed(points.join(marks, keys, "left_anti"), asks.join(marks, keys, "left_anti"), keys, limit)
    many = _by_ranks(points.join(marks, keys, "left_semi"), asks.join(marks, keys, "left_semi"), keys, sizes, limit)
    return few.unionByName(many)
