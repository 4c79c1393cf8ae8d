"""The ranks of a public byte-level BPE file; the file stays where it is and is named by its path."""

from __future__ import annotations

import base64
from functools import lru_cache

import public_tokenizers


def default_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str):
    """A library encoder over the file, kept by the worker process."""
    import tiktoken

    return tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}
    )
