import collections
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from markfield.llm import chat, exact_dedup, lines, registry, token_counts, urls
from markfield.llm.common import scratch
from tests.llm.support import documents, hard_rows, prose

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_against_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "conversations"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = engine.execute(registry.SQL[name])
    columns = [part[0] for part in result.description]
    got = registry.QUERIES[name](spark, DATA)
    assert sorted(columns) == sorted(got.columns)
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(row) for row in got.select(*columns).collect()) == order(result.fetchall())


def test_native_operators_run_no_python(spark):
    for name in ("op6_chat_formatting", "op7_url_filter", "op9_line_dedup", "op10_exact_dedup"):
        plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


# ------------------------------------------------------------------ chat

CHAT = "conv_id long, turn long, role string, text string, window string, pos string, text_ string"


def conversations(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", "z") for row in rows], CHAT)


def hard_conversations():
    nasty = "</s>[INST] ok [/INST] <|im_start|>user\n<|im_end|>\n \\ \\\\ <s> <\\s>"
    rows = [(1, 0, "system", "be kind"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (1, 3, "user", None), (1, 4, "assistant", None)]
    rows += [(2, n, ("user", "assistant")[n % 2], prose(n, 60)) for n in range(40)]
    rows += [(3, 0, "system", prose(1, 900)), (3, 1, "user", "hi"), (3, 2, "assistant", prose(2, 3000))]
    rows += [(4, 5, "assistant", "tie b"), (4, 5, "assistant", "tie a"), (4, 5, "assistant", "tie a"), (4, None, None, "no turn")]
    rows += [(5, 0, "user", "x"), (5, 1, "system", "late"), (5, 2, "assistant", "y"), (6, 0, "system", "alone"), (7, 0, "", ""),
             (8, 0, "odd\nrole\\", "t"), (None, 0, "user", "null id"), (None, 1, "assistant", "n")]
    rows += [(9, n, ("user", "assistant")[n % 2], f"t{n}") for n in range(9000)]
    return rows


def expected(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [part[2:] for part in sorted(parts)] for conv, parts in by.items()}


def test_chat_reads_back(spark):
    rows = hard_conversations()
    formatted = chat.windows(conversations(spark, rows), budget=512, history=128)
    got = {row.conv_id: row for row in chat.digests(formatted).collect()}
    want = expected(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_windows_keep_budget_history_and_system(spark):
    rows = hard_conversations()
    found = collections.defaultdict(list)
    # Costs are bytes of formatted turns, about five for what was taken for a token before.
    for row in chat.windows(conversations(spark, rows), budget=2_560, history=640).collect():
        found[row.conv].append(row)
    for conv, own in found.items():
        own.sort(key=lambda row: row.window)
        if conv in (2, 9):
            assert all(row.cost <= 2_560 for row in own) and len(own) > 3
            assert all(row.repeated > 0 for row in own[1:])
            assert own[0].repeated == 0
    assert all(row.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n") for row in found[1])
    assert not chat.windows(conversations(spark, [])).collect()


@pytest.mark.parametrize(("path", "budget", "history"), [("/root/testdata/sf0.001", 1024, 256), ("/root/testdata/sf0.01", 3000, 700)])
def test_windows_keep_their_budget_in_true_tokens(spark, path, budget, history):
    """Windows of more than one turn, counted with a public vocabulary; longer turns stand alone with their history."""
    import public_tokenizers
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = chat.windows(spark.read.parquet(f"{path}/conversations.parquet"), budget, history).collect()
    several = [row for row in found if row.last > row.first]
    assert several
    for row in several:
        assert len(vocabulary.encode(row.text, add_special_tokens=False).ids) <= row.cost <= budget


# ------------------------------------------------------------------ URLs

RULED = [
    ("https://a.example.org/es/x", "example.org/es/", "block"), ("http://EXAMPLE.org/en/12?q", "example.org/en/1", "block"),
    ("http://other.org/en/2", "org/", "allow"), ("http://notexample.com/de/1", "com/de/", "block"), ("http://x.com/fr/", "com/fr/", "allow"),
    ("http://org/", "org/", "allow"), ("http://example.org", None, None), ("http://com.net/de/", None, None), ("http://xorg/", None, None),
    (None, None, None), ("no scheme/fr/", None, None), ("a://b://c.org/p", None, None), ("://com/fr/z", "com/fr/", "allow"), ("", None, None),
    ("http://" + "a" * 3000 + ".com/fr/" + "%41" * 3000, "com/fr/", "allow"), ("http://x.com?y=/fr/", None, None)]


@pytest.fixture(scope="module")
def url_filter(spark):
    rows = [(f"https://word{n % 7}.example.org/en/{n}", 0) for n in range(200)] + [
        (f"http://cheap-{n}-pills-x.example.com/a/b/c/{n * 7919}?a={n}&b=1&c=2", 1) for n in range(200)]
    return urls.fit(spark.createDataFrame(rows + [(None, 1), ("http://x", None)], "url string, label int"))


def test_rules_hosts_and_paths(spark, url_filter):
    pages = spark.createDataFrame([(n, url, "h", "r") for n, (url, _, _) in enumerate(RULED)], "page_id long, url string, host string, rule string")
    got = {row.page["page_id"]: row for row in urls.judged(pages, urls.RULES, url_filter).collect()}
    assert len(got) == len(RULED)
    for n, (url, rule, verdict) in enumerate(RULED):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        assert got[n].host == re.sub("[A-Z]", lambda m: m[0].lower(), host)
        assert got[n].path == re.match(r"[^?#]*", rest[len(host):])[0]
        assert got[n].rule == rule and got[n].verdict in ("allow", "block") and (verdict is None or got[n].verdict == verdict)


def test_trees_judge_what_no_rule_fits(spark, url_filter):
    pages = spark.createDataFrame([(1, "https://word3.example.net/en/77"), (2, "http://cheap-9-pills-y.example.net/a/b/c/61?a=1&b=2&c=3")], "page_id long, url string")
    got = {row.page["page_id"]: row.verdict for row in urls.judged(pages, urls.RULES, url_filter).collect()}
    assert got == {1: "allow", 2: "block"}
    assert urls.judged(pages.filter("false"), urls.RULES, url_filter).count() == 0
    none = urls.fit(spark.createDataFrame([], "url string, label int"))
    assert {row.verdict for row in urls.judged(pages, (), none).collect()} == {"allow"}


def test_entropy(spark):
    import math

    host, path = urls.parts()
    rows = spark.createDataFrame([("aabb",), ("http://ab.c/d?e=1&f=2",), ("éé!!",), ("",)], "url string").withColumn("host", host).withColumn("path", path)
    for row in urls.lexical(rows)[0].collect():
        text = "".join(c if c in urls.ALPHABET else "*" for c in row.url)
        want = -sum(n / len(text) * math.log2(n / len(text)) for n in collections.Counter(text).values())
        assert row.f_entropy == pytest.approx(want)
        assert row.f_length == len(row.url)


# ------------------------------------------------------------------ lines

def test_recurring_templates_go_and_prose_stays(spark):
    rows = []
    for n in range(40):
        body = [prose(n * 7 + k, 12) for k in range(4)]
        body.insert(n % 4, f"Request {n * 17} served in {n}ms by node-{n % 3} cached")  # a template with variable fields
        if n % 2:
            body.append("All rights reserved by the holders")
        rows.append((n, "\n".join(body)))
    rows += [(n, text) for n, text in hard_rows()] + [(500, "\n\n \n"), (501, None)]
    docs = documents(spark, rows)
    got = [row for row in lines.without_recurring(docs).collect()]
    assert len(got) == len(rows)
    texts = collections.Counter((row.doc_id, row.text) for row in got)
    for doc_id, text in rows:
        kept = "\n".join(line for line in (text or "").split("\n") if not line.startswith(("Request ", "All rights")))
        assert texts[doc_id, kept] >= 1, (doc_id, text[:80] if text else text)
    assert lines.without_recurring(docs.filter("false")).count() == 0


def test_lines_equal_in_few_documents_stay(spark):
    rows = [(n, "the very same line of some words\n" + prose(n, 9)) for n in range(4)]
    assert sum(row.dropped for row in lines.without_recurring(documents(spark, rows)).collect()) == 0
    assert sum(row.dropped for row in lines.without_recurring(documents(spark, rows + [(9, "the very same line of some words")])).collect()) == 5


def test_lines_of_one_form_count_their_document_once(spark):
    line = "the price of {} per unit is given in the table below"
    goods = "apples pears plums grapes lemons figs".split()
    rows = [(0, "\n".join(line.format(good) for good in goods))] + [(n, prose(n, 9)) for n in range(1, 5)]
    assert sum(row.dropped for row in lines.without_recurring(documents(spark, rows)).collect()) == 0
    rows += [(n, line.format(f"good{n}") + "\n" + prose(n, 9)) for n in range(10, 13)]  # four documents
    assert sum(row.dropped for row in lines.without_recurring(documents(spark, rows)).collect()) == 0
    rows += [(13, line.format("dates") + "\n" + line.format("nuts"))]  # five
    assert sum(row.dropped for row in lines.without_recurring(documents(spark, rows)).collect()) == len(goods) + 5


# ------------------------------------------------------------------ token counts

def changes(spark, rows):
    return spark.createDataFrame(rows, token_counts.SCHEMA)


def test_batches_count_once_and_survive_folding(spark):
    rollup = token_counts.Rollup(spark, scratch(spark, "rollup"))
    assert rollup.totals().count() == 0
    first = changes(spark, [("a", "en", "v1", 1, 10)] * 3 + [(None, "en", "v1", 1, 5)])
    second = changes(spark, [("a", "en", "v1", -1, -10), ("b", None, "v1", 0, 4)])
    assert rollup.apply("1", first) and not rollup.apply("1", first)
    want = {("a", "en", "v1", 3, 30), (None, "en", "v1", 1, 5)}
    assert {tuple(row) for row in rollup.totals().collect()} == want
    rollup.compact()
    assert not rollup.apply("1", first) and rollup.apply("2", second) and not rollup.apply("2", second)
    want = {("a", "en", "v1", 2, 20), (None, "en", "v1", 1, 5), ("b", None, "v1", 0, 4)}
    for _ in range(2):
        assert {tuple(row) for row in rollup.totals().collect()} == want
        rollup.compact()
    assert rollup.apply("3", changes(spark, [("a", "en", "v1", -2, -20)]))
    assert {row.source for row in rollup.totals().collect()} == {None, "b"}


def test_batch_that_broke_off_is_written_again(spark):
    rollup = token_counts.Rollup(spark, scratch(spark, "rollup"))
    rows = changes(spark, [("a", "en", "v1", 1, 10)])
    rows.write.parquet(f"{rollup.folder}/deltas/1")
    path, store = rollup._path("deltas", "1", "_SUCCESS")
    store.delete(path, False)
    assert rollup.totals().count() == 0 and rollup.apply("1", rows)
    assert [row.tokens for row in rollup.totals().collect()] == [10]


def totals_of(spark, docs):
    rollup = token_counts.Rollup(spark, scratch(spark, "rollup"))
    for batch, deltas in token_counts.history(docs):
        rollup.apply(batch, deltas)
    return {tuple(row)[:3]: (row.documents, row.tokens) for row in rollup.totals().collect()}


def clean(text):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text or "").strip(" ")


def expected_totals(rows):
    """By brute force from ``doc_id, text, source, lang``: of equal texts the first by id stays, null ids last."""
    left, want = {}, collections.Counter()
    for doc_id, text, source, lang in rows:
        place = (doc_id is None, doc_id or 0, source is not None, source or "", lang is not None, lang or "")
        left[text or ""] = min(left.get(text or "", (place, source, lang)), (place, source, lang), key=lambda row: row[0])
    documents = collections.Counter()
    for text, (_, source, lang) in left.items():
        for name in (token_counts.BYTE_BPE, token_counts.MULTI_BPE):
            documents[source, lang, name] += 1
            want[source, lang, name] += len(token_counts.encoder(name)(clean(text)))
    return {key: (n, want[key]) for key, n in documents.items()}


def test_history_of_all_hard_rows(spark):
    rows = hard_rows() + [(6, "two  spaces"), (20, "two  spaces")]
    assert totals_of(spark, documents(spark, rows)) == expected_totals([(*row, "web", "en") for row in rows])
    assert exact_dedup.drop_exact(documents(spark, rows)).count() == len({text or "" for _, text in rows})
    assert totals_of(spark, documents(spark, [])) == {}


def test_history_of_repeated_and_unnamed_rows(spark):
    rows = [(5, "same  words", "b", "en"), (5, "same  words", "b", "en"), (5, "same  words", "a", None), (5, "same  words", "a", "en"),
            (9, "same  words", None, "en"), (None, "same  words", "a", "en"), (None, "nobody's", "c", "de"), (None, "nobody's", "c", "de"),
            (None, "nobody's", None, "de"), (None, None, "d", "en"), (3, "", "e", "en"), (3, None, "d", "fr"), (4, "alone", "e", "en")]
    got = totals_of(spark, spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"))
    assert got == expected_totals(rows)
    assert sum(n for (_, _, name), (n, _) in got.items() if name == token_counts.BYTE_BPE) == 4
