"""Token counts by a public tokenizer whose vocabulary file stays where it is."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

#: Where the vocabulary files are; never copied.
TOKENIZER_FOLDER = os.environ.get("RILLWORK_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.tiktoken"

#: Fixed value: how byte-level BPE splits text before merging.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def encoding(path: str):
    """The tokenizer of a file of ranks; special tokens in a text are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def counter(path: str):
    """A function from text to its number of tokens; every text is encoded whole, which takes time in proportion to its length."""
    enc = encoding(path)
    return lambda text: len(enc.encode_ordinary(text)) if text else 0
