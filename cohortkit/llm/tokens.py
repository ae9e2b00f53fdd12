"""Byte-level BPE ids of many texts.

The vocabulary's pre-tokens never reach across a space that has a non-space character behind it, so
a text is cut there and each part encoded once per worker: parts repeat far more often than texts.
Texts that hold a special token's string go to the ``tokenizers`` library whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CACHED_PARTS = 240_000  # parts kept by a worker; then it starts anew
_CUT = re.compile(r" (?=\S)")
_NO_CUT = re.compile(r" (?!\S)")


class _Parts(dict):
    """Text part (the space before it left out) -> its ids as little-endian unsigned 32-bit."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        if len(self) >= CACHED_PARTS:
            self.clear()
        out = np.array(self.encode(" " + part), "<u4").tobytes()
        if len(part) < 64:
            self[part] = out
        return out


@lru_cache(maxsize=1)
def _whole(tokenizer: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


@lru_cache(maxsize=2)
def _load(tokenizer: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    special = [t.content for t in Tokenizer.from_file(tokenizer).get_added_tokens_decoder().values()]  # few texts need more of it
    ranks_file = re.sub(r"\.json$", ".tiktoken", tokenizer)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_file, "rb"))}  # noqa: SIM115
    bpe = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return special, bpe, _Parts(bpe.encode_ordinary)


def encode_column(column: pa.Array, tokenizer: str, special_ids: bool = True) -> Iterator[np.ndarray]:
    """Ids (unsigned 32-bit) of each text, as ``tokenizers`` gives them for the file ``tokenizer``
    with add_special_tokens=False; null: none. The same vocabulary's ranks lie beside the file.
    Without ``special_ids`` a special token's string in a text is ordinary text."""
    special, bpe, parts = _load(tokenizer)
    for text in column:
        text = text.as_py()
        if not text:
            yield np.zeros(0, np.uint32)
        elif special_ids and any(s in text for s in special):
            yield np.array(_whole(tokenizer).encode(text, add_special_tokens=False).ids, np.uint32)
        else:
            first, *rest = _CUT.split(text) if _NO_CUT.search(text) else text.split(" ")
            head = np.array(bpe.encode_ordinary(first), "<u4").tobytes()
            yield np.frombuffer(head + b"".join(map(parts.__getitem__, rest)), "<u4")
