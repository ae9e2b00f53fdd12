"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than space and the controls 9 to 13 (``[^\\x20\\x09-\\x0D]+``), or other
than those of a table of one's own; only A-Z are lower-cased. Words, lines and shingles are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # texts handled at once, at some 60 bytes of numbers a byte; a longer text is handled alone
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (SplitMix64)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_WEIGHTS = mix(np.arange(1 << 12)) | np.uint64(1)


def weights(n: int) -> np.ndarray:
    """The first n of a fixed sequence of odd 64-bit weights."""
    global _WEIGHTS
    if n > len(_WEIGHTS):
        _WEIGHTS = mix(np.arange(1 << int(n - 1).bit_length())) | np.uint64(1)
    return _WEIGHTS[:n]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run values[start:end] (runs ascending, not overlapping; may be empty)."""
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(ends > starts)
    if len(full):
        lengths = (ends - starts)[full]
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        place = np.arange(lengths.sum()) - np.repeat(at, lengths)
        own = values[place + np.repeat(starts[full], lengths)].astype(np.uint64) + np.uint64(1)
        out[full] = np.add.reduceat(own * weights(int(lengths.max()))[place], at)
    return mix(out ^ mix(ends - starts))


class Texts:
    """Some texts: their bytes, the words' bounds, and the first word of each text."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, gap: np.ndarray = SPACE):
        self.data, self.bounds = data, bounds
        word = ~gap[data]
        edge = np.diff(word.astype(np.int8))
        begins = np.flatnonzero(edge == 1) + 1
        if len(word) and word[0]:
            begins = np.concatenate([[0], begins])
        # a text's end also ends a word
        inner = bounds[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        inner = np.unique(inner)
        inner = inner[word[inner] & word[inner - 1]] if len(inner) else inner
        self.begins = np.sort(np.concatenate([begins, inner])).astype(np.int64)
        ends = np.flatnonzero(edge == -1) + 1
        if len(word) and word[-1]:
            ends = np.concatenate([ends, [len(word)]])
        self.ends = np.sort(np.concatenate([ends, inner])).astype(np.int64)
        self.first_word = np.searchsorted(self.begins, bounds)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def word_hashes(self, lower: bool = True) -> np.ndarray:
        return run_hashes(LOWER[self.data] if lower else self.data, self.begins, self.ends)


def text_chunks(column: pa.Array | pa.ChunkedArray, gap: np.ndarray = SPACE) -> Iterator[tuple[int, int, Texts]]:
    """(first row, last row + 1, texts) of a string column; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        before = 0
        for chunk in column.chunks:
            yield from ((before + a, before + b, texts) for a, b, texts in text_chunks(chunk, gap))
            before += len(chunk)
        return
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        yield at, to, Texts(data[offsets[at]:offsets[to]], (offsets[at:to + 1] - offsets[at]).astype(np.int64), gap)
        at = to


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window words[i:i+size] (len(words) - size + 1 of them, none if too few)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    w = weights(size)
    out = words[:n] * w[0]
    for j in range(1, size):
        out = out + words[j:j + n] * w[j]
    return mix(out ^ mix(np.array([size]))[0])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; fewer words are one shingle together."""
    return np.unique(window_hashes(words, min(size, max(1, len(words)))))
