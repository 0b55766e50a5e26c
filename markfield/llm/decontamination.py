"""Benchmark decontamination: a BM25 index of test items searched with block-max WAND.

Test items (question and answer) are cut into segments and indexed; BM25 impacts are divided by the score
a segment gives itself, so one threshold holds for long and short items. Every training document is cut
into overlapping passages of words and every passage is a query; all segments above the threshold are retrieved.
A retrieved item counts as leaked when at least four fifths of its question's five-word shingles, or of the whole item's,
stand near the passage; the overlap with the answer is reported beside it.

The index is built from the items alone and shipped to the tasks in shards of a bounded number of characters;
more items mean more passes, not larger shards. Documents are only scanned: no shuffle, whole texts.

Null text counts as empty and leaks nothing; an item without words is not indexed; an item of fewer
than five words must occur as a whole; equal items are reported each; repeated documents are judged each; extra columns
pass through. Empty documents or items give an empty result.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import settle, slices, table, whole

WORD = re.compile(r"\w+")
#: Question, and answer if there is white space after a sentence's end: the last sentence.
LAST_SENTENCE = r"(?s)^(.*[.!?])\s+(\S.*)$"
ARROW = {"bigint": "int64", "int": "int32", "string": "string"}
HIT = "array<struct<item_id:{id},score:double,question_overlap:double,answer_overlap:double,at:long>>"


@dataclass
class Settings:
    passage: int = 64  #: words of a passage; half of it is the step
    segment: int = 48  #: words of an indexed segment at most
    threshold: float = 0.5  #: share of a segment's own score
    shingle: int = 5
    overlap: float = 0.8
    k1: float = 1.2
    b: float = 0.75
    block: int = 4  #: segments of a block
    cells: int = 1 << 20  #: block bounds held at once
    short: int = 128  #: a term in more blocks than this counts with one maximum
    shard_chars: int = 8_000_000  #: characters of items in one shipped shard


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: Sequence[str], width: int) -> set[tuple[str, ...]]:
    """Runs of ``width`` words; of fewer words the whole run; of none nothing."""
    return {tuple(words[n:n + width]) for n in range(max(1, len(words) - width + 1))} if words else set()


@dataclass
class Postings:
    """One term: its segments in rising order, their impacts, and the blocks they lie in with their maxima."""

    segments: list[int] = field(default_factory=list)
    impacts: list[float] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    block_max: list[float] = field(default_factory=list)

    def close(self, size: int) -> None:
        for segment, impact in zip(self.segments, self.impacts):
            if not self.blocks or self.blocks[-1] != segment // size:
                self.blocks.append(segment // size)
                self.block_max.append(impact)
            else:
                self.block_max[-1] = max(self.block_max[-1], impact)


class Index:
    """BM25 postings of the segments of some items, in blocks of segments of like weight."""

    def __init__(self, items: Sequence[tuple[int, str, str]], settings: Settings) -> None:
        self.settings = settings
        self.items, self.question, self.answer, self.whole, self.length = [], [], [], [], []
        bags: list[tuple[int, Counter]] = []
        for item_id, question, answer in items:
            asked, told = words_of(question), words_of(answer)
            if not asked and not told:
                continue
            number = len(self.items)
            self.items.append(item_id)
            self.length.append(len(asked) + len(told))
            self.question.append(shingles(asked or told, settings.shingle))
            self.answer.append(shingles(told or asked, settings.shingle))
            self.whole.append(shingles(asked + told, settings.shingle))
            both, parts = asked + told, -(-(len(asked) + len(told)) // settings.segment)
            bags += [(number, Counter(both[len(both) * n // parts:len(both) * (n + 1) // parts])) for n in range(parts)]
        self.terms: dict[str, int] = {}
        self.postings: list[Postings] = []
        self._fill(bags)
        self._bounds()

    def _fill(self, bags: list[tuple[int, Counter]]) -> None:
        """Impacts: BM25 with items as documents, as shares of the segment's own score."""
        frequency = Counter(term for _, bag in bags for term in bag)
        rarity = {term: float(np.log1p((len(bags) - n + 0.5) / (n + 0.5))) for term, n in frequency.items()}
        mean = sum(bag.total() for _, bag in bags) / max(1, len(bags))
        k1, b = self.settings.k1, self.settings.b
        scored = []
        for owner, bag in bags:
            damping = k1 * (1 - b + b * bag.total() / mean)
            impact = {term: rarity[term] * n * (k1 + 1) / (n + damping) for term, n in bag.items()}
            scored.append((sum(impact.values()), owner, impact))
        scored.sort(key=lambda segment: segment[:2])
        self.owner = [owner for _, owner, _ in scored]
        for segment, (own, _, impact) in enumerate(scored):
            for term, value in impact.items():
                number = self.terms.setdefault(term, len(self.terms) + 1)  # 0: a word of no item
                if number > len(self.postings):
                    self.postings.append(Postings())
                self.postings[number - 1].segments.append(segment)
                self.postings[number - 1].impacts.append(value / own)
        for posting in self.postings:
            posting.close(self.settings.block)

    def _bounds(self) -> None:
        """Flat arrays of block maxima; terms of many blocks count with their overall maximum in every block."""
        short = [0, *(len(p.blocks) if len(p.blocks) <= self.settings.short else 0 for p in self.postings)]
        self.base = np.array([0.0, *(0.0 if n else max(p.block_max) for n, p in zip(short[1:], self.postings))])
        self.first = np.concatenate([[0], np.cumsum(short)])
        self.count = np.array(short)
        kept = [p for n, p in zip(short[1:], self.postings) if n]
        self.flat_blocks = np.array([block for p in kept for block in p.blocks], np.int64)
        self.flat_max = np.array([top for p in kept for top in p.block_max])
        self.block_count = -(-len(self.owner) // self.settings.block)

    def live(self, ids: np.ndarray, passages: int) -> Iterator[tuple[int, int]]:
        """Passages and blocks whose block maxima could reach the threshold together.

        Maxima are summed per half passage; passage ``n`` is the halves ``n`` and ``n + 1``.
        """
        step, least, wide = self.settings.passage // 2, self.settings.threshold - 1e-6, self.block_count
        slab = max(1, self.settings.cells // wide)
        for low in range(0, passages, slab):
            high = min(low + slab, passages)
            part = ids[low * step:(high + 1) * step]
            part = np.unique((np.arange(len(part)) // step) * len(self.count) + part)  # a term counts once in a half
            half, term = np.divmod(part, len(self.count))
            runs = self.count[term]
            place = np.arange(runs.sum()) + np.repeat(self.first[term] - np.cumsum(runs) + runs, runs)
            sums = np.bincount(np.repeat(half * wide, runs) + self.flat_blocks[place], self.flat_max[place],
                               (high - low + 1) * wide).reshape(-1, wide)
            sums = sums + np.bincount(half, self.base[term], high - low + 1)[:, None]
            start, block = np.nonzero(sums[:-1] + sums[1:] >= least)
            yield from zip((start + low).tolist(), block.tolist())

    def search(self, terms: Sequence[int], block: int) -> list[tuple[int, float]]:
        """Segments of a block whose score for the distinct ``terms`` reaches the threshold (block-max WAND).

        Lists stand in order of their next segment. The pivot is the first list at which the sum of the lists' maxima
        in this block reaches the threshold: no earlier segment can.
        """
        low, high, least = block * self.settings.block, (block + 1) * self.settings.block, self.settings.threshold - 1e-9
        lists = []
        for term in terms:
            posting = self.postings[term - 1]
            place = bisect_left(posting.blocks, block)
            if place < len(posting.blocks) and posting.blocks[place] == block:
                at = bisect_left(posting.segments, low)
                lists.append([posting.segments[at], at, posting.block_max[place], posting])
        found = []
        while lists:
            lists.sort(key=lambda cursor: cursor[0])
            bound, pivot = 0.0, None
            for cursor in lists:
                bound += cursor[2]
                if bound >= least:
                    pivot = cursor[0]
                    break
            if pivot is None:
                break
            if lists[0][0] == pivot:
                score = sum(cursor[3].impacts[cursor[1]] for cursor in lists if cursor[0] == pivot)
                if score >= least:
                    found.append((pivot, score))
                pivot += 1
            for cursor in lists:
                if cursor[0] < pivot:
                    cursor[1] = bisect_left(cursor[3].segments, pivot, cursor[1])
                    cursor[0] = cursor[3].segments[cursor[1]] if cursor[1] < len(cursor[3].segments) else high
            lists = [cursor for cursor in lists if cursor[0] < high]
        return found

    def leaks(self, text: str) -> list[tuple[int, float, float, float, int]]:
        """Item id, best score, question and answer overlap and first word of the passage, per leaked item."""
        words, step = words_of(text), self.settings.passage // 2
        if not words or not self.items:
            return []
        ids = np.fromiter(map(self.terms.get, words, itertools.repeat(0)), np.int64, len(words))
        passages = max(1, -(-len(words) // step) - 1)
        best: dict[tuple[int, int], float] = {}
        for n, block in self.live(ids, passages):
            terms = np.unique(ids[n * step:n * step + self.settings.passage])
            for segment, score in self.search(terms[terms > 0].tolist(), block):
                key = (self.owner[segment], n * step)
                best[key] = max(score, best.get(key, 0.0))
        return self._verified(words, best)

    def _verified(self, words: list[str], best: dict) -> list[tuple[int, float, float, float, int]]:
        kept: dict[int, tuple] = {}
        for (item, start), score in best.items():
            reach = self.length[item]
            around = words[max(0, start - reach):start + self.settings.passage + reach]
            near, parts = shingles(around, self.settings.shingle), (self.question[item], self.answer[item], self.whole[item])
            short = [run for part in parts for run in part if len(run) < self.settings.shingle]
            if short:
                flat = f" {' '.join(around)} "
                near |= {run for run in short if f" {' '.join(run)} " in flat}
            share = [len(part & near) / len(part) for part in parts]
            if max(share[0], share[2]) >= self.settings.overlap:
                found = (share[0], share[1], score, start)
                kept[item] = max(kept.get(item, found), found, key=lambda hit: (hit[:3], -hit[3]))
        return sorted((self.items[item], score, asked, told, start) for item, (asked, told, score, start) in kept.items())


def question_and_answer(text: str = "text") -> tuple[Column, Column]:
    """An item given as one text: its last sentence is the answer, what stands before it the question."""
    body = F.trim(whole(text))
    return (F.when(body.rlike(LAST_SENTENCE), F.regexp_extract(body, LAST_SENTENCE, 1)).otherwise(body),
            F.when(body.rlike(LAST_SENTENCE), F.regexp_extract(body, LAST_SENTENCE, 2)).otherwise(F.lit("")))


def shards(items: DataFrame, settings: Settings) -> Iterator[list[tuple[int, str, str]]]:
    """Items of ``item_id, question, answer`` in lists of at most ``shard_chars`` characters (or one item)."""
    held: list[tuple[int, str, str]] = []
    size = 0
    for row in items.select("item_id", whole("question").alias("q"), whole("answer").alias("a")).orderBy("item_id").toLocalIterator():
        if held and size + len(row.q) + len(row.a) > settings.shard_chars:
            yield held
            held, size = [], 0
        held.append((row.item_id, row.q, row.a))
        size += len(row.q) + len(row.a)
    yield held


def hits(spark: SparkSession, items: Sequence[tuple[int, str, str]], settings: Settings, kind: str, text: Column) -> Column:
    """Leaked items of one shard in a whole text. A shipped index holds at most ``shard_chars`` characters of items."""
    shipped = spark.sparkContext.broadcast(Index(items, settings))
    cells = pa.list_(pa.struct([("item_id", pa.type_for_alias(ARROW[kind])), ("score", pa.float64()),
                                ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()), ("at", pa.int64())]))
    names = ("item_id", "score", "question_overlap", "answer_overlap", "at")

    @F.arrow_udf(HIT.format(id=kind))
    def found(texts: pa.Array) -> pa.Array:
        index = shipped.value
        return pa.array([[dict(zip(names, hit)) for hit in index.leaks(text)]
                         for part in slices(texts) for text in part.to_pylist()], cells)

    return found(whole(text))


def leaks(docs: DataFrame, items: DataFrame, settings: Settings | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, at`` of every leaked item."""
    settings = settings or Settings()
    kind = items.schema["item_id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = [rows.select("doc_id", F.explode(hits(docs.sparkSession, part, settings, kind, F.col("text"))).alias("hit")).select(
        "doc_id", "hit.*") for part in shards(items, settings)]
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result


def drop_leaked(docs: DataFrame, items: DataFrame, settings: Settings | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a test item; every shard is one filtering pass."""
    settings = settings or Settings()
    kind = items.schema["item_id"].dataType.simpleString()
    kept = docs
    for number, part in enumerate(shards(items, settings)):
        kept = settle(kept, "decontaminated") if number else kept
        kept = kept.filter(F.size(hits(docs.sparkSession, part, settings, kind, F.col(text_col))) == 0)
    return kept


def test_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    question, answer = question_and_answer()
    return table(spark, sf_dir, "benchmark").select("item_id", question.alias("question"), answer.alias("answer"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked test items of every document."""
    found = leaks(table(spark, sf_dir, "documents"), test_items(spark, sf_dir))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "question_overlap", "answer_overlap", "at")
