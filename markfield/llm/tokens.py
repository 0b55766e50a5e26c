"""Token ids of public vocabularies inside Spark tasks; the vocabulary's path is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

import numpy as np

BYTE_BPE = "byte_bpe_50k.tiktoken"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
# How the byte-level vocabularies split text before merging, and their one special string. The split
# is the published one with possessive repeats, which match the same pieces without going back.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SPECIAL = {"<|endoftext|>": 50256}


def resolve(vocabulary: str) -> str:
    """A path as it is; a bare file name among the installed public vocabularies."""
    if "/" in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


@lru_cache(maxsize=4)
def encoder(vocabulary: str = BYTE_BPE) -> Callable[[str], np.ndarray]:
    """A function from text to uint32 ids, loaded once per worker; the special string becomes its own id."""
    import tiktoken

    with open(resolve(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    coding = tiktoken.Encoding(vocabulary, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=SPECIAL)
    special = tuple(SPECIAL)

    def encode(text: str) -> np.ndarray:
        if any(mark in text for mark in special):
            return coding.encode_to_numpy(text, allowed_special="all").astype("<u4")
        return coding.encode_to_numpy(text, disallowed_special=()).astype("<u4")

    return encode
