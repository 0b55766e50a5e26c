"""Quality classifier: a byte-level convolutional network in numpy over overlapping chunks of the whole document.

Input planes are the bytes and one more that marks where eight bytes repeat those a short distance before. Learned
filters of six bytes slide over every second byte; their responses are max-pooled over chunks of 512 bytes that overlap
by half. Chunk features go on as their maximum and their mean over the document into one probability, so
neither a short passage nor a long tail is lost. Spark partitions the scoring; a task holds one slice of bytes and the
features of one document's chunks.

The fit runs on a bounded sample of labelled documents (``Settings.sample``, ``Settings.longest``); scoring has no bound.
Null text counts as empty; an empty document is one chunk of filler and gets a score like any other. Without usable
labels every score is one half. Repeated rows are scored each; no column is added to
the caller's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from markfield.llm.common import slices, table, whole
from markfield.llm.toxicity import held_out, labelled

WIDTH = 6
HOP = 256  #: bytes between chunk starts; a chunk is two hops
LAGS = 48
GRAM = 8
SLICE = 1 << 19
THRESHOLD = 0.3


@dataclass
class Settings:
    sample: int = 3_000  #: labelled documents of the fit
    longest: int = 16_384  #: bytes of a document of the fit at most
    filters: int = 16
    updates: int = 600
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


@dataclass
class Layout:
    """Texts as one run of bytes, each filled up in front with zeros to whole hops, and the chunks of each.

    The filler is longer than a filter and the look back, so no text sees another.
    """

    data: np.ndarray
    hops: np.ndarray  # per text

    @classmethod
    def of(cls, texts: Sequence[str]) -> Layout:
        raw = [text.encode("utf-8", "surrogatepass") for text in texts]
        hops = np.array([-(-(len(part) + LAGS + GRAM) // HOP) for part in raw], np.int64)
        return cls(np.frombuffer(b"".join(part.rjust(n * HOP, b"\0") for part, n in zip(raw, hops.tolist())), np.uint8), hops)

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and second hop of every chunk, and the first chunk of every text."""
        count = np.maximum(self.hops - 1, 1)
        starts = np.cumsum(count) - count
        first = np.arange(count.sum()) - np.repeat(starts, count) + np.repeat(np.cumsum(self.hops) - self.hops, count)
        return first, first + np.repeat((self.hops > 1).astype(np.int64), count), starts


def repeats(data: np.ndarray) -> np.ndarray:
    """Share of sampled places per hop where eight bytes equal those 1 to ``LAGS`` bytes before; filler never counts."""
    padded = np.concatenate([np.zeros(LAGS, np.uint8), data, np.zeros(GRAM, np.uint8)])
    grams = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, GRAM)).view(np.uint64)[:, 0]
    here = grams[LAGS:LAGS + len(data):GRAM]
    hit = np.zeros(len(here), bool)
    for lag in range(1, LAGS + 1):
        hit |= here == grams[LAGS - lag:LAGS - lag + len(data):GRAM]
    return (hit & (here != 0)).reshape(-1, HOP // GRAM).mean(1)


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, filters); byte zero is filler and weighs nothing
    shift: np.ndarray
    weights: np.ndarray  # maximum and mean of chunk features
    bias: float

    def __post_init__(self) -> None:
        self.pairs = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"pairs": None}

    def hop_features(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Strongest response of every filter per hop, and the share of repeats; slice by slice."""
        if self.pairs is None:  # two bytes looked up at once
            self.pairs = [(a[:, None] + b[None]).transpose(1, 0, 2).reshape(65536, -1)
                          for a, b in zip(self.filters[::2], self.filters[1::2])]
        peaks, shares = [], []
        for low in range(0, len(data), SLICE):
            high = min(low + SLICE, len(data))
            part = np.zeros(high - low + WIDTH, np.uint8)
            part[:min(high + WIDTH, len(data)) - low] = data[low:high + WIDTH]
            index, count = part.view("<u2"), (high - low) // 2
            response = self.pairs[0].take(index[:count], axis=0)
            for place in (1, 2):
                response += self.pairs[place].take(index[place:place + count], axis=0)
            peaks.append(response.reshape(-1, HOP // 2, response.shape[1]).max(1))
            back = min(low, HOP)
            shares.append(repeats(data[low - back:high])[back // HOP:])
        return np.concatenate(peaks), np.concatenate(shares)

    def combined(self, layout: Layout, peaks: np.ndarray, shares: np.ndarray) -> dict[str, np.ndarray]:
        first, second, starts = layout.chunks()
        chosen = np.where(peaks[first] >= peaks[second], first[:, None], second[:, None])
        raw = np.take_along_axis(peaks, chosen, 0) + self.shift
        chunk = np.concatenate([np.maximum(raw, 0), ((shares[first] + shares[second]) / 2)[:, None]], 1)
        count = np.diff(np.append(starts, len(first)))
        top = np.maximum.reduceat(chunk, starts)
        mean = np.add.reduceat(chunk, starts) / count[:, None]
        return {"chosen": chosen, "raw": raw, "chunk": chunk, "count": count, "top": top, "features": np.hstack([top, mean])}

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """Probability that each whole text is of quality; texts are taken together up to a slice of bytes."""
        out, held, size = [], [], 0
        for text in [*texts, None]:
            if held and (text is None or size + len(text) > SLICE // 2):
                layout = Layout.of(held)
                features = self.combined(layout, *self.hop_features(layout.data))["features"]
                out.append(1 / (1 + np.exp(-np.clip(features @ self.weights + self.bias, -40, 40))))
                held, size = [], 0
            if text is not None:
                held.append(text)
                size += len(text) + HOP
        return np.concatenate(out) if out else np.zeros(0)


class Adam:
    def __init__(self, rate: float) -> None:
        self.rate, self.step, self.first, self.second = rate, 0, {}, {}

    def move(self, **slopes: np.ndarray) -> dict[str, np.ndarray]:
        self.step += 1
        moves = {}
        for name, slope in slopes.items():
            self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * slope
            self.second[name] = 0.999 * self.second.get(name, 0) + 0.001 * slope ** 2
            moves[name] = self.rate * (self.first[name] / (1 - 0.9 ** self.step)) / (
                np.sqrt(self.second[name] / (1 - 0.999 ** self.step)) + 1e-8)
        return moves


def fit(texts: Sequence[str], labels: Sequence[int], settings: Settings | None = None) -> Network:
    """Network trained by gradient descent; gradients pass through the places where a maximum was found."""
    settings = settings or Settings()
    random, count = np.random.default_rng(settings.seed), settings.filters
    filters = random.normal(0, 0.15, (WIDTH, 256, count)).astype(np.float32)
    filters[:, 0] = 0
    network = Network(filters, np.zeros(count, np.float32), np.zeros(2 * count + 2), 0.0)
    if len(set(labels)) < 2:
        return network
    network.weights = random.normal(0, 0.1, 2 * count + 2)
    marks, adam = np.asarray(labels, float), Adam(settings.rate)
    for _ in range(-(-settings.updates // -(-len(texts) // settings.batch))):
        order = random.permutation(len(texts))
        for low in range(0, len(order), settings.batch):
            _step(network, adam, [texts[n] for n in order[low:low + settings.batch]], marks[order[low:low + settings.batch]])
    return network


def _step(network: Network, adam: Adam, texts: Sequence[str], marks: np.ndarray) -> None:
    layout, count = Layout.of(texts), len(network.shift)
    data = np.append(layout.data, np.zeros(WIDTH, np.uint8))
    places = np.arange(0, len(layout.data), 2)
    response = sum(network.filters[n].take(data[places + n], axis=0) for n in range(WIDTH)).reshape(-1, HOP // 2, count)
    where = response.argmax(1)
    peaks = np.take_along_axis(response, where[:, None], 1)[:, 0]
    found = network.combined(layout, peaks, repeats(layout.data))
    error = (1 / (1 + np.exp(-np.clip(found["features"] @ network.weights + network.bias, -40, 40))) - marks) / len(marks)
    owner = np.repeat(np.arange(len(texts)), found["count"])
    back = error[:, None] * network.weights
    highest = found["chunk"] == found["top"][owner]
    chunk = back[owner][:, :count + 1] * highest + (back / found["count"][:, None])[owner][:, count + 1:]
    raw = chunk[:, :count] * (found["raw"] > 0)
    active, filter_ = np.nonzero(raw)
    hop = found["chosen"][active, filter_]
    start = hop * HOP + 2 * where[hop, filter_]
    slope = np.zeros_like(network.filters)
    for n in range(WIDTH):
        np.add.at(slope[n], (data[start + n], filter_), raw[active, filter_])
    slope[:, 0] = 0
    moves = adam.move(filters=slope + 1e-5 * network.filters, shift=raw.sum(0),
                      weights=found["features"].T @ error + 1e-4 * network.weights, bias=error.sum())
    network.filters -= moves["filters"].astype(np.float32)
    network.shift -= moves["shift"].astype(np.float32)
    network.weights = network.weights - moves["weights"]
    network.bias -= float(moves["bias"])


def score(spark: SparkSession, network: Network, text: Column) -> Column:
    """Quality of a whole text. The size of the network that is shipped is fixed by its settings."""
    shipped = spark.sparkContext.broadcast(network)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        network = shipped.value
        return pa.array(np.concatenate([np.zeros(0), *(network.scores(part.to_pylist()) for part in slices(texts))]), pa.float64())

    return scores(whole(text))


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str, settings: Settings | None = None) -> Network:
    """Network from the given labels, without those whose remainder is held out."""
    settings = settings or Settings()
    usable = docs.filter(F.octet_length(whole("text")) <= settings.longest)
    sample = labelled(usable, table(spark, sf_dir, "labels"), "quality", ~held_out(parts=5, part=0), settings.sample)
    rows = sample.select("id", "text", "label").orderBy("id", "text").collect()
    return fit([row.text for row in rows], [row.label for row in rows], settings)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.withColumn("score", score(spark, trained(spark, docs, sf_dir), F.col("text")))
    return found.select("doc_id", held_out(parts=5, part=0).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
