"""Toxicity classifier regularised by counterfactuals.

A logistic model over words and word beginnings. Its terms are chosen by Spark from how labelled documents use
them; its weights are fitted on a bounded sample. For every sentence of that sample that names a group, the
name is swapped for the others of its list, and the square of the change of the score is penalised beside the
usual loss; the same penalty holds for a name put into a sentence that has none. So a name alone moves no
score, and neutral mentions are not flagged.

A score counts each term of the whole text once, however often it occurs, so neither length nor repetition
dilutes it. Null text counts as empty and gets the score of a text without known terms; without usable labels every
score is one half. Repeated rows are scored each; labels of an id are reduced to their maximum; no
column is added to the caller's.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import slices, table, whole

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[.!?\n]+")
BEGINNINGS = (4, 5, 6, 7)
# Lists of group names; the names of one list stand in for each other.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("deaf", "blind", "disabled", "autistic"),
    ("immigrant", "refugee", "foreigner", "native"),
)
THRESHOLD = 0.3


@dataclass
class Settings:
    """Bounds of the fit. Scoring has none."""

    sample: int = 8_000  #: labelled documents read for the fit
    terms: int = 4_096  #: terms kept
    least: int = 3  #: labelled documents a term must occur in
    evidence: float = 3.0  #: standard errors a term's share among toxic documents must lie above or below the rest
    pairs: int = 4_000  #: counterfactual sentences
    swap_weight: float = 4.0
    ridge: float = 1e-3
    rounds: int = 400
    identity: Sequence[Sequence[str]] = field(default_factory=lambda: IDENTITY_TERMS)


@dataclass
class Model:
    places: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        found = {self.places[term] for term in terms_of(text) if term in self.places}
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[list(found)].sum(), -40, 40))))


def terms_of(text: str) -> set[str]:
    """Lower-cased words of the whole text and their beginnings, marked by a star."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{word[:size]}*" for word in words for size in BEGINNINGS if len(word) > size}


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, sample: int,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, label`` of a bounded sample of usable labelled documents, chosen by a hash of the id.

    Only ids take part in the choice, so the bounded top list moves no texts; the chosen ids are then few enough
    to be broadcast at any size of the corpus.
    """
    marks = labels.filter(usable & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(label).cast("int")).alias("label"))
    ids = docs.select(F.col(id_col).alias("id")).distinct().join(marks, "id")
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(sample)
    return docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).join(
        F.broadcast(chosen), "id")


def _encoded(rows: DataFrame, places: dict[str, int] | None, identity: Sequence[Sequence[str]], room: int) -> DataFrame:
    """Per document its terms (all, or the places of known ones), label and sentences for counterfactuals."""
    names = {name for group in identity for name in group}
    schema = "label int, terms array<string>" if places is None else "label int, places array<int>, sentences array<string>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(slices, batches)):
            texts, marks = batch.column(0).to_pylist(), batch.column(1)
            if places is None:
                yield pa.RecordBatch.from_arrays([marks, pa.array([list(terms_of(text)) for text in texts],
                                                                  pa.list_(pa.string()))], names=["label", "terms"])
                continue
            known, spoken = [], []
            for text in texts:
                known.append(sorted(places[term] for term in terms_of(text) if term in places))
                parts = [part.strip() for part in SENTENCE.split(text) if 0 < len(part.strip()) <= 400]
                naming = [part for part in parts if names & set(WORD.findall(part.lower()))]
                spoken.append((naming + parts)[:room])
            yield pa.RecordBatch.from_arrays([marks, pa.array(known, pa.list_(pa.int32())),
                                              pa.array(spoken, pa.list_(pa.string()))], names=["label", "places", "sentences"])

    return rows.select("text", "label").mapInArrow(run, schema)


def choose_terms(rows: DataFrame, settings: Settings) -> list[str]:
    """The terms whose share among toxic documents stands out most, counted by Spark; at most ``settings.terms``."""
    marked = _encoded(rows, None, settings.identity, 0)
    totals = rows.groupBy().agg(F.sum("label"), F.count("label")).first()
    toxic, clean = (totals[0] or 0), (totals[1] or 0) - (totals[0] or 0)
    if not toxic or not clean:
        return []
    counts = marked.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.sum("label").alias("hit"), F.count("label").alias("n"))
    share = toxic / (toxic + clean)
    spread = F.sqrt(F.col("n") * share * (1 - share))
    gap = (F.col("hit") - F.col("n") * share) / spread
    return [row.term for row in counts.filter(F.col("n") >= settings.least).withColumn("gap", gap)
            .filter(F.abs("gap") >= settings.evidence).orderBy(F.desc(F.abs("gap")), "term").limit(settings.terms).collect()]


def counterfactuals(sentence: str, identity: Sequence[Sequence[str]], serial: int) -> list[tuple[str, str]]:
    """The sentence with each group name swapped for another of its list; one without a name also with one put in."""
    words = sentence.split()
    found = [(at, group) for at, word in enumerate(words) for group in identity if word.lower().strip(",;:") in group]
    if found:
        return [(sentence, " ".join([*words[:at], name, *words[at + 1:]]))
                for at, group in found for name in group if name != words[at].lower().strip(",;:")]
    names = [name for group in identity for name in group]
    if not names:
        return []
    at = serial % (len(words) + 1)
    return [(sentence, " ".join([*words[:at], names[serial % len(names)], *words[at:]]))]


def fit(rows: DataFrame, settings: Settings | None = None) -> Model:
    """Model from ``text, label`` rows of a bounded sample (see :func:`labelled`)."""
    settings = settings or Settings()
    terms = choose_terms(rows, settings)
    places = {term: n for n, term in enumerate(terms)}
    empty = Model(places, np.zeros(len(terms)), 0.0)
    if not terms:
        return empty
    examples = _encoded(rows, places, settings.identity, 2).collect()
    labels = np.array([row.label for row in examples], float)
    owner = np.repeat(np.arange(len(examples)), [len(row.places) for row in examples])
    term = np.concatenate([np.array(row.places, int) for row in examples])
    sentences = [text for row in examples for text in row.sentences][:settings.pairs]
    pairs = [pair for n, text in enumerate(sentences) for pair in counterfactuals(text, settings.identity, n)][:settings.pairs]
    changes = []
    for n, (one, other) in enumerate(pairs):
        a, b = ({places[t] for t in terms_of(text) if t in places} for text in (one, other))
        changes += [(n, place, 1.0) for place in a - b] + [(n, place, -1.0) for place in b - a]
    pair, moved, sign = (np.array(part) for part in zip(*changes)) if changes else (np.zeros(0, int),) * 3
    pair, moved = pair.astype(int), moved.astype(int)

    weights, bias = np.zeros(len(terms)), float(np.log((labels.mean() + 1e-6) / (1 - labels.mean() + 1e-6)))
    momentum, energy, slow, fast = np.zeros(len(terms) + 1), np.zeros(len(terms) + 1), 0.9, 0.999
    for step in range(1, settings.rounds + 1):
        raw = bias + np.bincount(owner, weights[term], len(examples))
        error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels) / len(labels)
        slope = np.bincount(term, error[owner], len(terms)) + settings.ridge * weights
        if len(pair):
            change = np.bincount(pair, sign * weights[moved], len(pairs))
            slope += settings.swap_weight * 2 / len(pairs) * np.bincount(moved, sign * change[pair], len(terms))
        whole_slope = np.append(slope, error.sum())
        momentum = slow * momentum + (1 - slow) * whole_slope
        energy = fast * energy + (1 - fast) * whole_slope ** 2
        move = 0.05 * (momentum / (1 - slow ** step)) / (np.sqrt(energy / (1 - fast ** step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return Model(places, weights, bias)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """Toxicity of a whole text. The model that is shipped holds at most ``Settings.terms`` terms."""
    shipped = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        model = shipped.value
        return pa.array([model.score(text) for part in slices(texts) for text in part.to_pylist()], pa.float64())

    return scores(whole(text))


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str, settings: Settings | None = None) -> Model:
    """Model from the given labels, without those whose remainder is held out."""
    settings = settings or Settings()
    return fit(labelled(docs, table(spark, sf_dir, "labels"), "toxic", ~held_out(), settings.sample), settings)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.withColumn("score", score(spark, trained(spark, docs, sf_dir), F.col("text")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
