import collections
import random
import zlib

import numpy as np
import pytest

from markfield.llm import packing
from markfield.llm.tokens import BYTE_BPE, encoder
from tests.llm.support import documents, hard_rows, prose


def reference_ids(texts):
    from tokenizers import Tokenizer

    import public_tokenizers

    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [known.encode(text, add_special_tokens=False).ids for text in texts]


def test_ids_equal_the_reference_library():
    texts = ["", " ", "\n\n  x", "it's we'll  \t end ", "<|endoftext|> in <|endoftext|>text", "a" * 500, "漢字 かな 123 4", "é́​",
             "x\r\n\r\ny", "  ", prose(3, 200), "...!!! ??? $$$", "'S 'LL don't", "   x"]
    encode = encoder(BYTE_BPE)
    assert [encode(text).tolist() for text in texts] == reference_ids(texts)


@pytest.mark.parametrize("total", [1, 7, 2047, 2048, 2049, 4096, 5000])
def test_cut(total):
    spans = list(packing.cut(total))
    assert [start for start, _ in spans] == list(np.cumsum([0] + [n for _, n in spans])[:-1])
    assert sum(n for _, n in spans) == total and all(n == 2048 for _, n in spans[1:])


def test_best_two_fit_holds_every_piece_and_is_tight():
    draw = random.Random(4)
    for lengths in ([], [2048], [1] * 10, [700] * 9, [draw.randint(1, 2048) for _ in range(3000)],
                    [int(draw.lognormvariate(5.5, 0.8)) % 2048 + 1 for _ in range(3000)]):
        bins = packing.best_two_fit(np.array(lengths, int))
        assert collections.Counter(n for b in bins for n in b) == collections.Counter(lengths)
        assert all(sum(b) <= 2048 for b in bins)
        if len(lengths) > 100:
            first_fit = []
            for n in sorted(lengths, reverse=True):
                place = next((i for i, room in enumerate(first_fit) if room >= n), None)
                if place is None:
                    first_fit.append(2048 - n)
                else:
                    first_fit[place] -= n
            assert len(bins) <= 1.005 * len(first_fit) + 1


def test_replaces_the_smallest_by_two_that_fit_more_tightly():
    assert packing.best_two_fit(np.array([60, 30, 25, 14]), 100)[0] == [60, 25, 14]


def test_packed_rows(spark):
    rows = hard_rows()
    docs = documents(spark, rows)
    cut_pieces = packing.pieces(docs, BYTE_BPE)
    placed = packing.packed(cut_pieces, group=8).collect()
    want = collections.Counter()
    for (doc_id, _), ids in zip(rows, reference_ids([text or "" for _, text in rows])):
        ids = np.array(ids + [0], "<u4")
        for piece, (start, length) in enumerate(packing.cut(len(ids))):
            want[doc_id, piece, start, length, zlib.crc32(ids[start:start + length].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in placed) == want
    by = collections.defaultdict(list)
    for row in placed:
        by[row.sequence_id].append((row.offset, row.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    whole = {row.sequence_id: row for row in packing.sequences(packing.packed(cut_pieces, group=8)).collect()}
    assert len(whole) == len(by) and all(len(row.ids) == 4 * row.length for row in whole.values())


def test_empty_table(spark):
    assert packing.result(documents(spark, []), BYTE_BPE).count() == 0
