"""Byte-level BPE encoding and decoding with batched merge rounds in numpy.

Texts are split into words where they lie. The symbols of all words not met before stand in one flat array, and a
round looks up every neighbouring pair by binary search over the sorted keys of the merge table, takes the lowest rank
of each word and merges all its places at once, from the left where they overlap. Words without a mergeable pair leave
the array; the others go on. A worker keeps the ids of words it has met, up to a bound of words and bytes, after which
it forgets them all; that changes the work, never the ids. Decoding gathers the bytes of the ids from one flat table.

Both are maps over rows: no shuffle, and rows of any source or length weigh what their own text weighs. A null text is
empty and has no ids; null ids decode to an empty text; ids outside the vocabulary decode to nothing; repeated rows and
null identifiers are kept; other columns pass through, and an added column whose name is taken is refused; an empty
table gives no rows.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import slices, table, whole
from markfield.llm.tokens import SPLIT, resolve

BYTE_BPE_JSON = "byte_bpe_50k.json"
#: The code points that count as white space between words.
SPACES = r"\t-\r \x85\xa0  -     　"
#: Words and bytes of words a worker remembers before it forgets them all.
REMEMBERED, REMEMBERED_BYTES = 200_000, 16 << 20
ROWS = 128
NEVER = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Vocabulary:
    byte_ids: np.ndarray  #: id of each single byte
    keys: np.ndarray  #: sorted ``left * size + right`` of all merges
    ranks: np.ndarray  #: rank of each key
    merged: np.ndarray  #: id that each key becomes
    size: int
    data: np.ndarray  #: bytes of all ids, one after another
    ends: np.ndarray  #: end of each id in ``data``, after a leading zero
    special: dict[str, int]


def printable_bytes() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself where it prints, else the next one above 255."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (byte for byte in range(256) if byte not in set(shown))
    return {chr(byte): byte for byte in shown} | {chr(256 + n): byte for n, byte in enumerate(hidden)}


@lru_cache(maxsize=2)
def vocabulary(path: str = BYTE_BPE_JSON) -> Vocabulary:
    with open(resolve(path), encoding="utf-8") as lines:
        told = json.load(lines)
    ids, letters = told["model"]["vocab"], printable_bytes()
    special = {token["content"]: token["id"] for token in told["added_tokens"]}
    size = max([*ids.values(), *special.values()]) + 1
    pieces = [b""] * size
    for token, number in ids.items():
        pieces[number] = bytes(letters[letter] for letter in token)
    for token, number in special.items():
        pieces[number] = token.encode()
    pairs = [tuple(merge.split(" ")) if isinstance(merge, str) else tuple(merge) for merge in told["model"]["merges"]]
    keys = np.array([ids[left] * size + ids[right] for left, right in pairs], np.int64)
    merged = np.array([ids[left + right] for left, right in pairs], np.int64)
    order = np.argsort(keys)
    byte_ids = np.empty(256, np.int64)
    for letter, byte in letters.items():
        byte_ids[byte] = ids[letter]
    return Vocabulary(byte_ids, keys[order], order.astype(np.int64), merged[order], size,
                      np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)]), special)


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``data`` at ``starts``, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def merge_rounds(words: Sequence[bytes], known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and how many each word has."""
    symbols = known.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
    ready: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        place = np.zeros(len(symbols), np.int64)
        rank = np.full(len(symbols), NEVER)
        pair = symbols[:-1] * known.size + symbols[1:]
        place[:-1] = np.minimum(np.searchsorted(known.keys, pair), len(known.keys) - 1)
        found = np.flatnonzero((known.keys[place[:-1]] == pair) & (owner[1:] == owner[:-1]))
        rank[found] = known.ranks[place[found]]
        least = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(symbols)))
        open_ = least != NEVER
        if not open_.all():
            ready.append((owner[~open_], symbols[~open_]))
        at = np.flatnonzero((rank == least) & open_)
        starts = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.zeros(0, bool)
        run = np.arange(len(at)) - np.flatnonzero(starts)[np.cumsum(starts) - 1] if len(at) else at
        at = at[run % 2 == 0]
        symbols[at] = known.merged[place[at]]
        open_[at + 1] = False
        symbols, owner = symbols[open_], owner[open_]
    owners = np.concatenate([part[0] for part in ready]) if ready else np.zeros(0, np.int64)
    ids = np.concatenate([part[1] for part in ready]) if ready else np.zeros(0, np.int64)
    return ids[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


class Encoder:
    """Ids of texts; remembers the words it has met."""

    def __init__(self, path: str = BYTE_BPE_JSON) -> None:
        import regex

        self.known = vocabulary(path)
        self.words = regex.compile(SPLIT.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(
            r"\s", f"[{SPACES}]")).findall
        self.special = regex.compile("|".join(f"({regex.escape(mark)})" for mark in self.known.special)) if self.known.special else None
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {mark: n for n, mark in enumerate(self.known.special)}
        self.pool = np.array(list(self.known.special.values()), np.int64)
        self.starts = np.arange(len(self.pool))
        self.lengths = np.ones(len(self.pool), np.int64)

    def split(self, text: str) -> list[str]:
        """The words of a text and its special strings, in order."""
        if not any(mark in text for mark in self.known.special):
            return self.words(text)
        parts = (part for part in self.special.split(text) if part)
        return [*itertools.chain.from_iterable([part] if part in self.known.special else self.words(part) for part in parts)]

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has."""
        if len(self.numbers) > REMEMBERED or len(self.pool) > REMEMBERED_BYTES:
            self.forget()
        split = [self.split(text) for text in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        flat = [*itertools.chain.from_iterable(split)]
        known = len(self.numbers)
        new = [word for word in dict.fromkeys(flat) if word not in self.numbers]
        if new:
            self.numbers.update(zip(new, range(known, known + len(new))))
            ids, lengths = merge_rounds([word.encode("utf-8", "surrogatepass") for word in new], self.known)
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
            self.lengths = np.concatenate([self.lengths, lengths])
            self.pool = np.concatenate([self.pool, ids])
        number = np.fromiter(map(self.numbers.__getitem__, flat), np.int64, len(flat))
        sizes = self.lengths[number]
        before = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(counts)
        return gathered(self.pool, self.starts[number], sizes), before[ends] - before[ends - counts]


def decode(ids: np.ndarray, counts: np.ndarray, known: Vocabulary) -> list[str]:
    """Texts of ids, ``counts`` of them each; broken UTF-8 becomes replacement characters."""
    valid = (ids >= 0) & (ids < known.size)
    inside = np.where(valid, ids, 0)
    sizes = np.where(valid, np.diff(known.ends)[inside], 0)
    data = gathered(known.data, known.ends[inside], sizes).tobytes()
    before = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.cumsum(counts)
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(before[ends - counts].tolist(), before[ends].tolist())]


def _added(rows: DataFrame, kind: str, name: str) -> str:
    if name in rows.columns:
        raise ValueError(f"column {name} is there already")
    return ", ".join([*(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields), f"`{name}` {kind}"])


def encoded(docs: DataFrame, path: str = BYTE_BPE_JSON, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text as an array of ints."""
    width, schema = len(docs.columns), _added(docs, "array<int>", ids_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in itertools.chain.from_iterable(slices(batch, ROWS) for batch in batches):
            ids, counts = encoder.encode(batch.column(width).to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], lists], names=[*batch.schema.names[:width], ids_col])

    return docs.select("*", whole(text_col).alias("_text")).mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str = BYTE_BPE_JSON, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of every array of ids."""
    width, schema = len(rows.columns), _added(rows, "string", text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in itertools.chain.from_iterable(slices(batch, ROWS) for batch in batches):
            lists = batch.column(width)
            ids = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = pa.array(decode(ids, counts, known), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], texts], names=[*batch.schema.names[:width], text_col])

    empty = F.array().cast("array<int>")
    return rows.select("*", F.coalesce(F.col(ids_col), empty).alias("_ids")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, digests of its ids and of the text they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decoded(encoded(docs).select("doc_id", "ids"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
