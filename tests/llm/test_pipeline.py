import pytest

import corpus_pipeline
from markfield.llm import decontamination, simhash, toxicity
from tests.llm.support import documents, hard_rows

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Kept rows after every stage but the last, on the given tables with hard rows added."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.unionByName(documents(spark, [(None if i is None else 10**6 + i, t) for i, t in hard_rows()], ()))
    model = toxicity.trained(spark, docs, DATA)
    found = [{"name": "given", "rows": docs.collect(), "docs": docs}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        found.append({"name": name, "rows": docs.collect(), "docs": docs})
    return found, model


def test_stages_keep_columns_and_order(stages):
    found, _ = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    for stage in found:
        assert stage["docs"].columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_against_brute_force(spark, stages):
    found, model = stages
    given, toxic, exact, near, clean = ([(r.doc_id, r.text or "") for r in s["rows"]] for s in found)
    order = lambda rows: sorted(rows, key=str)
    assert order(toxic) == order(row for row in given if model.score(row[1]) < toxicity.THRESHOLD)
    assert len(toxic) < len(given)
    last = {}
    for doc_id, text in toxic:
        last[text] = max([last.get(text), doc_id], key=lambda i: (i is not None, i))
    assert order(exact) == order((doc_id, text) for text, doc_id in last.items())
    kept = {text for _, text in near}
    sets = {text: set(simhash.shingle_hashes(text, 5).tolist()) for _, text in exact}
    gone = [text for _, text in exact if text not in kept]
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    assert all(any(similar(sets[text], sets[other]) for other in sets if other != text) for text in gone)
    pairs = [(a, b) for a in kept for b in kept if a < b and similar(sets[a], sets[b])]
    assert not pairs  # found all there are in this table
    items = [(r.item_id, r.question, r.answer) for r in decontamination.test_items(spark, DATA).collect()]
    whole = [" ".join(decontamination.words_of(f"{q} {a}")) for _, q, a in items]
    leaked = [text for _, text in near if any(item in " ".join(decontamination.words_of(text)) for item in whole)]
    assert leaked and not {text for _, text in clean} & set(leaked)
    assert len(near) - len(clean) <= len(leaked) + 2


def test_run_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_stages_on_empty_tables(spark):
    docs = documents(spark, [], ())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0, name
