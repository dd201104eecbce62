"""Public tokenizers by file; the files are read where the work runs, never shipped."""

from __future__ import annotations

import base64
from functools import lru_cache

from skyledger.llm.chunks import PieceCache


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def rank_counter(path: str) -> PieceCache:
    """Token counts of pieces, by the library that reads rank files."""
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={}
    )
    return PieceCache(lambda new: [len(encoding.encode_ordinary(piece)) for piece in new])
