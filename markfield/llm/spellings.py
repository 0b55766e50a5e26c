"""Spelling variants of a corpus' words, found in tries of letter-group counts.

Words are counted over all texts (combined before the shuffle). The letters of the counted words are dealt into
``GROUPS`` groups of about equal weight; a word's vector holds how many of its letters are in each group. One inserted,
deleted or replaced letter adds at most one to one group and takes at most one from another. A trie arranges words by
their successive counts; a search goes down depth first, spending a budget of one surplus and one deficit, and the words
of the leaves it reaches are verified letter by letter. Each pair is looked for from one side: from the longer word, or
from the word whose first differing count is the smaller.

The trie is cut below its first levels into shards, as many levels as it takes for the counted shards to be small, and
words ask in every shard their budget reaches; a shard that stays large is parted and asked in all its parts. The
result is the same for any number of levels and parts. A word of many near words gives one row per task, not its pairs.

A null text has no words, a null identifier counts as empty; repeated rows count each; words may be of any length;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import CRC_SQL, crc32_sql, settle, small_side, table

#: The letters of a word, and the letters that have a lower case here.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORTEST, LEAST, CUT, LEAD = 7, 2, 31, 10
GROUPS = 14
#: Words of a shard, about; levels of the trie that shards may take up.
SHARD, LEVELS = 30_000, 8
#: Asking words taken down the trie at once; letters compared at once.
ASKING, COMPARED = 8_192, 4_000_000
BROADCAST_ROWS = 200_000


# ------------------------------------------------------------------ words

def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shortest: int = SHORTEST, least: int = LEAST,
          cut: int = CUT) -> DataFrame:
    """``word, n``: words of at least ``shortest`` letters that occur ``least`` times.

    A run of letters whose ``crc32("<id>:<run>")`` is a multiple of ``cut`` loses one letter, named by that number.
    """
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    rows = rows.select(lower.alias("run"), F.crc32(F.concat("id", F.lit(":"), lower)).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    word = F.when(F.col("h") % cut == 0, short).otherwise(F.col("run"))
    return rows.select(word.alias("word")).filter(F.length("word") >= shortest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def letter_groups(vocabulary: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters dealt into groups of about equal weight, the heaviest letters first."""
    weights = vocabulary.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").groupBy("letter").agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "letter").collect()  # as many rows as there are letters
    dealt, filled = [""] * groups, [0] * groups
    for row in weights:
        lightest = filled.index(min(filled))
        dealt[lightest] += row.letter
        filled[lightest] += row.n
    return dealt


# ------------------------------------------------------------------ one shard: trie, search, verification

class Words:
    """Words as one array of letters, with the vectors of their letter groups."""

    def __init__(self, texts: list[str], groups: list[str]) -> None:
        self.texts = texts
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
        group_of = np.zeros(256, np.int64)
        for number, letters in enumerate(groups):
            group_of[list(letters.encode("latin-1"))] = number
        owner = np.repeat(np.arange(len(texts)), self.lengths)
        cells = np.bincount(owner * len(groups) + group_of[self.letters], minlength=len(texts) * len(groups))
        self.vectors = cells.reshape(len(texts), len(groups))

    def rectangle(self, which: np.ndarray, length: int) -> np.ndarray:
        return self.letters[self.starts[which][:, None] + np.arange(length)]


class Trie:
    """Nodes of each level by (parent, count); the leaves are stretches of the words in the order of their vectors."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.order = np.lexsort(vectors.T[::-1])
        ranked = vectors[self.order]
        self.span = int(vectors.max(initial=0)) + 3
        new = np.zeros(len(ranked), bool)
        new[:1] = True
        node, self.keys = np.zeros(len(ranked), np.int64), []
        for level in range(vectors.shape[1]):
            new[1:] |= ranked[1:, level] != ranked[:-1, level]
            first = np.flatnonzero(new)
            self.keys.append(node[first] * self.span + ranked[first, level] + 1)
            node = np.cumsum(new) - 1
        self.leaves = np.append(np.flatnonzero(new), len(ranked))

    def child(self, level: int, node: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted children exist, and their nodes."""
        key = node * self.span + np.clip(count, -1, self.span - 2) + 1
        at = np.minimum(np.searchsorted(self.keys[level], key), len(self.keys[level]) - 1)
        there = np.flatnonzero(self.keys[level][at] == key)
        return there, at[there]

    def candidates(self, asked: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Asking rows, indexed rows, and whether all counts agree; at most about ``most`` pairs at once."""
        for low in range(0, len(asked), ASKING):
            rows = np.arange(low, min(low + ASKING, len(asked)))
            # Depth first; a batch has one depth and one state of the budget.
            stack = [(0, rows, np.zeros(len(rows), np.int64), 0, 0)]
            while stack:
                level, rows, node, surplus, deficit = stack.pop()
                if level == asked.shape[1]:
                    if surplus <= deficit:
                        yield from self._leaves(rows, node, not deficit, most)
                    continue
                wanted = asked[rows, level]
                for change in (0, 1, -1):
                    if change == 1 and (surplus or deficit) or change == -1 and deficit:
                        continue
                    there, child = self.child(level, node, wanted + change)
                    if len(there):
                        stack.append((level + 1, rows[there], child, surplus + (change == 1), deficit + (change == -1)))

    def _leaves(self, rows: np.ndarray, node: np.ndarray, equal: bool, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        sizes = self.leaves[node + 1] - self.leaves[node]
        part = (np.cumsum(sizes) - sizes) // most
        for number in np.unique(part):
            inside = part == number
            n = sizes[inside]
            ends = np.cumsum(n)
            at = np.repeat(self.leaves[node[inside]] - (ends - n), n) + np.arange(ends[-1])
            yield np.repeat(rows[inside], n), self.order[at], equal


def one_edit(asked: Words, left: np.ndarray, index: Words, right: np.ndarray) -> np.ndarray:
    """Which pairs differ by one replaced letter, or by one letter that only the asking word has."""
    near = np.zeros(len(left), bool)
    length, shorter = asked.lengths[left], index.lengths[right]
    for size in np.unique(length):
        step = max(1, COMPARED // int(size))
        for same in (True, False):
            pairs = np.flatnonzero((length == size) & (shorter == (size if same else size - 1)))
            for low in range(0, len(pairs), step):
                some = pairs[low:low + step]
                a = asked.rectangle(left[some], int(size))
                b = index.rectangle(right[some], int(size) - (not same))
                if same:
                    near[some] = (a != b).sum(1) == 1
                else:
                    front = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(1)
                    back = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(1)
                    near[some] = front + back >= size - 1
    return near


def searched(index: pa.Table, asking: pa.Table, groups: list[str]) -> pa.Table:
    """``word, n_near, best_n, best``: of both words of each pair found, how many near words and the one of largest n."""
    inside, asked = Words(index.column("word").to_pylist(), groups), Words(asking.column("word").to_pylist(), groups)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(inside.texts) and len(asked.texts):
        trie = Trie(inside.vectors)
        names = np.unique(np.array(inside.texts + asked.texts, object), return_inverse=True)[1]
        index_name, asked_name = names[:len(inside.texts)], names[len(inside.texts):]
        for left, right, equal in trie.candidates(asked.vectors, COMPARED // 16):
            if equal:
                kept = index_name[right] > asked_name[left]
                left, right = left[kept], right[kept]
            near = one_edit(asked, left, inside, right)
            found.append((left[near], right[near]))
    left = np.concatenate([pair[0] for pair in found]) if found else np.zeros(0, np.int64)
    right = np.concatenate([pair[1] for pair in found]) if found else np.zeros(0, np.int64)
    if not len(left):
        return pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()),
                         "best_n": pa.array([], pa.int64()), "best": pa.array([], pa.string())})
    texts = np.array(inside.texts + asked.texts, object)
    counts = np.concatenate([index.column("n").to_numpy(), asking.column("n").to_numpy()])
    one = np.concatenate([left + len(inside.texts), right])
    other = np.concatenate([right, left + len(inside.texts)])
    order = np.lexsort((names[other], -counts[other], names[one]))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], names[one][1:] != names[one][:-1]]))
    return pa.table({"word": pa.array(texts[one[first]].tolist(), pa.string()), "n_near": pa.array(np.diff(first, append=len(one))),
                     "best_n": pa.array(counts[other[first]]), "best": pa.array(texts[other[first]].tolist(), pa.string())})


# ------------------------------------------------------------------ all shards

def _count_of(letters: str) -> Column:
    return F.length("word") - F.length(F.translate("word", letters, ""))


def _shards(counts: list[Column]) -> Column:
    """The shards a word asks in: its own, one count more or less, one more and a later one less."""
    levels = len(counts)
    changes = [{}] + [{n: change} for n in range(levels) for change in (1, -1)]
    changes += [{n: 1, m: -1} for n in range(levels) for m in range(n + 1, levels)]
    named = [F.concat_ws(",", F.lit(""), *((counts[n] + change.get(n, 0)).cast("string") for n in range(levels)))
             for change in changes]
    return F.array(*named)


def near_words(vocabulary: DataFrame, groups: list[str] | None = None, shard: int = SHARD, levels: int = LEVELS) -> DataFrame:
    """``word, n_near, best, best_n`` of every word of ``word, n`` that has a word one edit away."""
    groups = groups or letter_groups(vocabulary)
    levels = min(levels, len(groups))
    names = [f"c{n}" for n in range(levels)]
    rows = settle(vocabulary.select("word", "n", *(_count_of(groups[n]).alias(names[n]) for n in range(levels))), "spellings")
    depths = rows.rollup(*names).agg(F.grouping_id().alias("left_out"), F.count(F.lit(1)).alias("n")).groupBy("left_out").agg(
        F.max("n").alias("n"))
    largest = {levels - int(row.left_out).bit_count(): row.n for row in depths.collect()}  # one row per level
    depth = next((n for n in range(levels + 1) if largest.get(n, 0) <= shard), levels)
    counts = [F.col(name) for name in names[:depth]]
    own = rows.select("word", "n", F.concat_ws(",", F.lit(""), *(count.cast("string") for count in counts)).alias("shard"))
    parts = own.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / (2 * shard)).cast("int").alias("parts"))
    parts = settle(parts, "spelling-shards")
    known = small_side(parts, parts.count(), BROADCAST_ROWS)
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    index = own.join(known, "shard").select(F.col("shard").alias("own_shard"), part.alias("own_part"),
                                            F.col("word").alias("word"), F.col("n").alias("n"))
    asking = rows.select("word", "n", F.explode(_shards(counts)).alias("shard")).join(known, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "word", "n")

    def search(index: pa.Table, asking: pa.Table) -> pa.Table:
        return searched(index, asking, groups)

    found = index.groupBy("own_shard", "own_part").cogroup(asking.groupBy("shard", "part")).applyInArrow(
        search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("top.best").alias("best"), (-F.col("top.minus")).alias("best_n"))


def roots(forms: DataFrame, most_rounds: int = 40) -> DataFrame:
    """``word, root`` of every word of ``word, form``: the end of its chain of forms, by doubling steps.

    A form is LEAD times as frequent as its word, so chains are short and have no circles.
    """
    reached = settle(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(most_rounds):
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = settle(reached.join(onward.hint("merge"), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        reached = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return reached
    raise RuntimeError(f"forms did not end within {most_rounds} rounds")


def variants(docs: DataFrame, lead: int = LEAD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word; see the module's contract."""
    vocabulary = settle(words(docs), "vocabulary")
    near = near_words(vocabulary)
    rows = vocabulary.join(near.hint("merge"), "word", "left")
    has_form = F.col("best_n") >= lead * F.col("n")
    rows = settle(rows.select("word", F.when(has_form, F.col("best")).alias("form"), "n",
                              F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(has_form, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(rows.filter("form is not null"))
    return rows.join(ends.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


#: Words are near if one is the other without one letter, or if both are
#: equal without the letter at one place.
SQL = f"""
WITH RECURSIVE {CRC_SQL},
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{{SHORTEST},}}')), '{UPPER}', '{LOWER}') AS run FROM documents),
keyed AS (SELECT id || ':' || run AS key, run FROM runs),
hashed AS (SELECT run, {crc32_sql('key')} AS h FROM keyed, crc),
said AS (SELECT CASE WHEN h % {CUT} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word FROM hashed),
vocabulary AS (SELECT word, count(*) AS n FROM said WHERE length(word) >= {SHORTEST} GROUP BY word HAVING count(*) >= {LEAST}),
without AS (SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM vocabulary)),
near AS (SELECT a.word, b.word AS other, b.n FROM without a JOIN without b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN vocabulary b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS best_n,
    list(other ORDER BY n DESC, other)[1] AS best FROM near GROUP BY word),
forms AS (SELECT v.word, CASE WHEN best_n >= {LEAD} * v.n THEN best END AS form, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN best_n >= {LEAD} * v.n THEN best_n END AS form_n FROM vocabulary v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT walk.word, forms.word, forms.form FROM walk JOIN forms ON forms.word = walk.next)
SELECT forms.word, forms.form, walk.at AS root, forms.n::BIGINT AS n, forms.n_near::BIGINT AS n_near, forms.form_n::BIGINT AS form_n
FROM forms JOIN walk ON walk.word = forms.word AND walk.next IS NULL
"""
