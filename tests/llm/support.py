"""Small hard inputs: nulls in any column, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SYLLABLES = "ka lo mi ru ten vos bal dri est fon gur hin".split()
#: Names that the operators use for columns of their own.
CLASHING = ("key", "digest", "keep", "kept", "members", "file", "row", "fp", "shard", "score", "toxicity", "text_", "host", "batch")


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 4))) for _ in range(words))


def documents(spark, rows, extra=CLASHING):
    """``doc_id, text, lang, source, n_chars`` and extra columns with clashing names."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
              T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    fields += [T.StructField(name, T.StringType()) for name in extra]
    full = [(doc_id, text, "en", "web", len(text or "")) + ("x",) * len(extra) for doc_id, text in rows]
    return spark.createDataFrame(full, T.StructType(fields))


def hard_rows():
    """Doc ids and texts with every awkward case once."""
    long = prose(1, 30_000)
    return [(1, prose(2, 300)), (2, None), (3, ""), (4, " \t\n "), (5, long), (6, prose(2, 300)), (6, prose(2, 300)),
            (7, prose(3, 2)), (None, prose(4, 50)), (8, prose(4, 50)), (9, "ünïcödé ÄÖ " * 40), (10, "</s>[INST] <|endoftext|> \\"),
            (11, prose(5, 120)), (12, prose(5, 119) + " altered"), (13, "a" * 5_000)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
