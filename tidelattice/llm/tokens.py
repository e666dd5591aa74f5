"""Sizes of texts in tokens of a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

#: Folder of the vocabulary files; every executor sees it at this path.
TOKENIZERS = os.environ.get("TIDELATTICE_TOKENIZERS", "/opt/tokenizers")
DEFAULT = "byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's texts were cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a file of ranks; one a process."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path(name: str = DEFAULT) -> str:
    return f"{TOKENIZERS}/{name}"


def encode(texts: list[str | None], path: str) -> list[list[int]]:
    """Token ids of each text, of the whole text; none for null."""
    e = encoder(path)
    return [e.encode_ordinary(t) if t else [] for t in texts]
