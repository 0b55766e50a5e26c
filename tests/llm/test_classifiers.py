import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from markfield.llm import quality, toxicity
from tests.llm.support import documents, hard_rows, prose

RUDE = ("zorg", "blit", "nask")


def labelled_rows(spark, count=300):
    draw, rows = random.Random(8), []
    for n in range(count):
        text, toxic = prose(n, draw.randint(20, 60)), n % 4 == 0
        if toxic:
            text += " " + " ".join(draw.sample(RUDE, 2))
        if n % 3 == 0:
            text += f". a muslim neighbour {'' if toxic else 'and friend '}came"
        junk = n % 5 == 0
        if junk:
            text = " ".join(word + "%%%" for word in text.split())
        rows.append((n, text, int(toxic), int(not junk)))
    return spark.createDataFrame(rows, "id long, text string, toxic int, quality int")


@pytest.fixture(scope="module")
def toxic_model(spark):
    return toxicity.fit(labelled_rows(spark).select("id", "text", F.col("toxic").alias("label")))


def test_toxic_words_decide_wherever_they_stand(toxic_model):
    assert toxic_model.score(prose(900, 40) + " zorg blit") > 0.5
    assert toxic_model.score(prose(901, 20_000) + " zorg nask") > 0.5  # a whole long text is read
    assert toxic_model.score(prose(902, 40)) < 0.3 and toxic_model.score("") < 0.5


def test_group_names_alone_move_no_score(spark, toxic_model):
    """Names that came more often with toxic examples weigh next to nothing under the penalty."""
    biased = labelled_rows(spark).select("id", F.when(F.col("toxic") == 1, F.concat("text", F.lit(". the muslim man"))).otherwise(
        F.col("text")).alias("text"), F.col("toxic").alias("label"))
    with_penalty = toxicity.fit(biased)
    without = toxicity.fit(biased, toxicity.Settings(swap_weight=0.0))
    sentence = "the muslim came"
    gap = lambda model: abs(model.score(sentence) - model.score("the hindu came"))
    assert gap(with_penalty) < 0.5 * gap(without)
    assert toxic_model.score("a muslim neighbour and a jewish friend") < 0.3


def test_counterfactuals_swap_inside_a_list_only():
    pairs = toxicity.counterfactuals("The Muslim, said so", (("muslim", "hindu"), ("gay", "straight")), 0)
    assert pairs == [("The Muslim, said so", "The hindu said so")]
    assert len(toxicity.counterfactuals("none here", (("muslim", "hindu"),), 3)) == 1
    assert toxicity.counterfactuals("none here", (), 3) == []


def test_toxicity_of_hard_rows(spark, toxic_model):
    docs = documents(spark, hard_rows())
    got = docs.withColumn("s", toxicity.score(spark, toxic_model, F.col("text"))).collect()
    assert len(got) == len(hard_rows()) and all(0 <= row.s <= 1 for row in got)
    assert [row.s for row in got] == [pytest.approx(toxic_model.score(row.text or "")) for row in got]


@pytest.mark.parametrize("label", [None, 0, 1])
def test_models_without_both_labels(spark, label):
    rows = spark.createDataFrame([(1, "some text", label)], "id long, text string, label int")
    assert toxicity.fit(rows.filter("label is not null")).score("any") == pytest.approx(0.5)
    network = quality.fit(["some text"], [label or 0])
    assert network.scores(["any", ""]) == pytest.approx([0.5, 0.5])


def test_sample_is_bounded_and_skips_held_out(spark):
    docs = documents(spark, [(n, f"text {n}") for n in range(60)] + [(7, "again"), (None, "none")])
    labels = spark.createDataFrame([(n, n % 2, None) for n in range(50)] + [(7, 1, 0), (None, 1, 1)], "doc_id long, toxic int, quality int")
    rows = toxicity.labelled(docs, labels, "toxic", ~toxicity.held_out(), 20).collect()
    import zlib

    ids = {row.id for row in rows}
    assert len(ids) == 20 and all(zlib.crc32(str(n).encode()) % 4 != 2 for n in ids)
    full = toxicity.labelled(docs, labels, "toxic", ~toxicity.held_out(), 1000).collect()
    assert {row.id for row in full} == {n for n in range(50) if zlib.crc32(str(n).encode()) % 4 != 2}
    assert toxicity.labelled(docs, labels.filter("false"), "toxic", ~toxicity.held_out(), 20).count() == 0


@pytest.fixture(scope="module")
def network(spark):
    rows = labelled_rows(spark, 200).collect()
    return quality.fit([row.text for row in rows], [row.quality for row in rows], quality.Settings(updates=200))


def test_quality_tells_junk_from_prose(network):
    clean = [prose(n, 80) for n in range(700, 740)]
    junk = [" ".join(word + "%%%" for word in text.split()) for text in clean]
    scores = network.scores(clean + junk)
    assert (scores[:40] > scores[40:].max()).mean() > 0.95


def test_scores_depend_on_a_text_alone(spark, network):
    texts = [text or "" for _, text in hard_rows()] + ["a" * 255, "b" * 256, "c" * 257, "é" * 300_000]
    together, alone = network.scores(texts), np.concatenate([network.scores([text]) for text in texts])
    assert together == pytest.approx(alone, abs=1e-5)
    docs = documents(spark, hard_rows())
    got = docs.select(quality.score(spark, network, F.col("text")).alias("s")).collect()
    assert [row.s for row in got] == pytest.approx(alone[:len(got)].tolist(), abs=1e-5)


def test_chunks_cover_every_hop_and_overlap():
    layout = quality.Layout.of(["", "x" * 1000, "y" * 200])
    first, second, starts = layout.chunks()
    assert set(first) | set(second) == set(range(layout.hops.sum()))
    assert ((second - first) <= 1).all() and len(starts) == 3


def test_repeats_see_short_cycles_and_no_filler():
    layout = quality.Layout.of(["same words " * 100, prose(5, 150), ""])
    shares = np.split(quality.repeats(layout.data), np.cumsum(layout.hops)[:-1])
    assert shares[0][1:].min() > 0.7 and shares[1].max() < 0.2 and shares[2].max() == 0


def test_gradient_follows_differences():
    """One update lowers the loss on its own batch."""
    texts, marks = [prose(1, 60), "%%% " * 60], np.array([1.0, 0.0])
    network = quality.fit(texts, [1, 0], quality.Settings(updates=1))
    before = network.scores(texts)
    adam = quality.Adam(0.01)
    for _ in range(30):
        quality._step(network, adam, texts, marks)
        network.pairs = None
    after = network.scores(texts)
    assert after[0] > before[0] and after[1] < before[1]
