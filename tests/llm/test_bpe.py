"""Batched BPE against the tokenizers library, and round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from markfield.llm import bpe
from tests.llm.support import documents, hard_rows

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path(bpe.BYTE_BPE_JSON))
    found.no_truncation()
    found.no_padding()
    return found


def ids_of(texts, encoder=None):
    ids, counts = (encoder or bpe.Encoder()).encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]


def test_drawn_texts(library):
    draw = random.Random(5)
    pieces = ["a", "aa", "b", "'s", " ", "  ", "\n", "é", "1", "23", "!", "<|endoftext|>", "漢", "😀", "́", "\x1c", "\x85", "　"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 40))) for _ in range(2_000)]
    want = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(texts) == want


def test_every_code_point_of_the_first_planes(library):
    texts = [f"a{chr(c)}{chr(c)} {chr(c)}1{chr(c)}." for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    encoder = bpe.Encoder()
    for low in range(0, len(texts), 20_000):
        part = texts[low:low + 20_000]
        assert ids_of(part, encoder) == [found.ids for found in library.encode_batch(part, add_special_tokens=False)]


def test_long_words_and_forgetting(library, monkeypatch):
    texts = ["a" * 30_000, "".join(random.Random(2).choices("abcdefgh", k=20_000)), " " * 10_000 + "x", "ab " * 5_000]
    want = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(texts) == want
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    encoder = bpe.Encoder()
    assert [ids_of([text], encoder)[0] for text in texts + texts] == want + want


def test_decoding_any_ids(library):
    draw = random.Random(3)
    lists = [[draw.randrange(50_257) for _ in range(draw.randint(0, 12))] for _ in range(1_000)]
    got = bpe.decode(np.array(sum(lists, []), np.int64), np.array([len(ids) for ids in lists]), bpe.vocabulary())
    assert got == [library.decode(ids, skip_special_tokens=False) for ids in lists]


def test_hard_rows_with_other_columns(spark, library):
    docs = documents(spark, hard_rows())
    coded = bpe.decoded(bpe.encoded(docs))
    assert coded.columns == [*docs.columns, "ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(hard_rows())
    for row in got:
        assert row.decoded == (row.text or "")
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
    with pytest.raises(ValueError):
        bpe.encoded(docs, ids_col="digest")
    assert bpe.decoded(bpe.encoded(documents(spark, []))).count() == 0


def test_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 99_999, -1, 65])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decoded(rows).orderBy("doc_id").collect()] == ["", "", "ab"]


def test_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = bpe.query(spark, DATA).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
