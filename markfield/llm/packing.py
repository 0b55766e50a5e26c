"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Documents are tokenised once into a table of pieces in the shared folder. Packing then reads only
key and length: pieces are dealt by a hash into groups of a counted size, and each group is packed
in one task from a histogram of its lengths, so a task holds a bounded number of small rows.

A bin is filled greedily with the longest piece that fits; then its smallest piece gives way to two
unpacked pieces if they fill the gap that opens more tightly. A group leaves at most a few bins
partly filled, so grouping costs far below one percent of the sequences.

Null text is empty and yields one piece holding only the end token; repeated rows and equal ids stay
apart by a row key; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import parts_for, settle, slices, table, whole
from markfield.llm.tokens import encoder

CAPACITY = 2048
END = 0
GROUP = 50_000
PIECES = "key long, doc_id {id}, piece int, start long, length long, ids binary"


def cut(total: int, capacity: int = CAPACITY) -> Iterator[tuple[int, int]]:
    """Start and length of each piece of ``total`` ids; only the first may be shorter than the rest."""
    first = total - capacity * ((total - 1) // capacity)
    yield 0, first
    for start in range(first, total, capacity):
        yield start, capacity


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Table ``key, doc_id, piece, start, length, ids`` in the shared folder; ids are little-endian uint32."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, serial = encoder(vocabulary), itertools.count(TaskContext.get().partitionId() << 36)
        tail = np.array([end], dtype="<u4")
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            rows: list[tuple] = []
            for place, text in enumerate(batch.column(1).to_pylist()):
                ids = np.concatenate([encode(text), tail])
                rows += [(next(serial), place, n, start, length, ids[start:start + length].tobytes())
                         for n, (start, length) in enumerate(cut(len(ids), capacity))]
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), batch.column(0).take(pa.array(columns[1], pa.int64())),
                 pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64()),
                 pa.array(columns[5], pa.binary())], names=["key", "doc_id", "piece", "start", "length", "ids"])

    texts = docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"))
    return settle(texts.mapInArrow(run, PIECES.format(id=kind.simpleString())), "pieces")


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins as lists of lengths, from the lengths of one group (each at most ``capacity``)."""
    left = np.bincount(lengths, minlength=capacity + 1).tolist()
    there = sum(1 << n for n, count in enumerate(left) if count)  # bit n: a piece of length n is left
    mirrored = sum(1 << (capacity - n) for n, count in enumerate(left) if count)
    bins: list[list[int]] = []

    def change(length: int, by: int) -> None:
        nonlocal there, mirrored
        before = left[length]
        left[length] = before + by
        if not before or not left[length]:
            there ^= 1 << length
            mirrored ^= 1 << (capacity - length)

    while there:
        gap, chosen = capacity, []
        while length := (there & ((2 << gap) - 1)).bit_length() - 1 if there & ((2 << gap) - 1) else 0:
            chosen.append(length)
            change(length, -1)
            gap -= length
        if gap and len(chosen) > 1:
            smallest = chosen.pop()
            two = tightest_two(left, there, mirrored, gap + smallest, smallest, capacity)
            if two:
                change(smallest, 1)
                for length in two:
                    change(length, -1)
                chosen += two
            else:
                chosen.append(smallest)
        bins.append(chosen)
    return bins


def tightest_two(left: list[int], there: int, mirrored: int, room: int, above: int, capacity: int) -> list[int]:
    """Two left lengths with the largest sum in ``(above, room]``, or nothing.

    Bit ``a`` of ``there & (mirrored shifted by total - capacity)`` says that ``a`` and ``total - a`` are both left.
    """
    for total in range(room, above, -1):
        shift = total - capacity
        both = there & (mirrored << shift if shift >= 0 else mirrored >> -shift)
        while both:
            a = both.bit_length() - 1
            if 0 < a < total and (2 * a != total or left[a] > 1):
                return [a, total - a]
            both ^= 1 << a
    return []


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``key, sequence_id, offset`` of every piece."""
    rows = cut_pieces.select("key", F.col("length").cast("int").alias("length"))
    groups = parts_for(rows.count(), group)
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
    dealt = dealt.repartition(groups, "group").sortWithinPartitions("group", "length", "key")

    def place(number: int, keys: np.ndarray, lengths: np.ndarray) -> pa.RecordBatch:
        next_of = np.searchsorted(lengths, np.arange(capacity + 2)).tolist()
        rows_, sequences, offsets = [], [], []
        for serial, chosen in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for length in chosen:
                rows_.append(next_of[length])
                next_of[length] += 1
                sequences.append((number << 32) + serial)
                offsets.append(at)
                at += length
        return pa.RecordBatch.from_arrays([pa.array(keys[rows_]), pa.array(sequences, pa.int64()),
                                           pa.array(offsets, pa.int64())], names=["key", "sequence_id", "offset"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = -1, []
        for batch in batches:
            keys, lengths, owners = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edges = [0, *(np.flatnonzero(np.diff(owners)) + 1).tolist(), len(owners)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if owners[low] != number and held:
                    yield place(number, *(np.concatenate(part) for part in zip(*held)))
                    held = []
                number = int(owners[low])
                held.append((keys[low:high], lengths[low:high]))
        if held:
            yield place(number, *(np.concatenate(part) for part in zip(*held)))

    return dealt.mapInArrow(run, "key long, sequence_id long, offset long")


def packed(cut_pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Every column of the pieces with ``sequence_id`` and ``offset``: the packed sequences in long form."""
    return cut_pieces.join(pack(cut_pieces, capacity, group), "key")


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: each sequence's ids in one cell (bounded by the capacity)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", F.unhex(F.array_join(F.transform("parts", lambda p: p["ids"]), "")).alias("ids"))


def result(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Placement and digest of every piece; the digest is taken of the ids in the written pieces."""
    cut_pieces = pieces(docs, vocabulary)
    placed = packed(cut_pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from markfield.llm.tokens import BYTE_BPE

    return result(table(spark, sf_dir, "documents"), BYTE_BPE)
