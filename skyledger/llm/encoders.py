"""Token ids of whole texts by public tokenizers, and the bytes of their tokens."""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

# Characters that every Unicode version and both byte-level libraries class alike: line feeds, printable
# ASCII, Latin letters and signs. Other texts go to the library of the file itself.
_PLAIN = re.compile("[\n -~¡-¬®-ɏ]*\\Z")


def byte_table() -> dict[str, int]:
    """The bytes that the characters of byte-level token names stand for: printable ones for
    themselves, the others, in order, for the characters from 256 on."""
    shown = {b for a, z in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(a), ord(z) + 1)}
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def byte_level_tokens(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level file; an id without an entry has none."""
    from tokenizers import Tokenizer

    named, table = Tokenizer.from_file(path).get_vocab(), byte_table()
    out = [b""] * (max(named.values()) + 1)
    for name, at in named.items():
        out[at] = bytes(table[c] for c in name) if all(c in table for c in name) else name.encode()
    return out


@lru_cache(maxsize=4)
def byte_level(path: str, specials: bool) -> Callable[[str], list[int]]:
    """An encoder of whole texts by a byte-level JSON file, without added tokens. ``specials``: whether the
    strings of special tokens in a text are those tokens, the library's default, or plain text.

    The library for rank files gives the same ids several times faster, so it takes the texts whose
    characters both class alike; special strings and other characters are left to the file's own.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.encode_special_tokens = not specials
    special = {t.content: at for at, t in own.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={t: at for at, t in enumerate(byte_level_tokens(path)) if t and at not in special.values()},
    )

    def encode(text: str) -> list[int]:
        if _PLAIN.match(text) and not (specials and any(s in text for s in special)):
            return fast.encode_ordinary(text)
        return own.encode(text, add_special_tokens=False).ids

    return encode


@lru_cache(maxsize=2)
def piece_model(path: str):
    """The processor of a piece file and the bytes of each of its ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for at in range(model.vocab_size()):
        name = model.id_to_piece(at)
        tokens.append(bytes([int(name[3:5], 16)]) if model.is_byte(at) else name.replace("▁", " ").encode())
    return model, tokens


def sizes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, tokens), np.int64, len(tokens))
