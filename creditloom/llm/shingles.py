"""Word shingles of texts as arrays of 64-bit hashes, vectorised over many texts at once."""

from __future__ import annotations

import numpy as np

_GAPS = np.zeros(256, dtype=bool)
_GAPS[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    with np.errstate(over="ignore"):
        x = x + _U((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    """_BASE ** 0 .. n modulo 2**64."""
    out = np.ones(n + 1, dtype=np.uint64)
    if n:
        with np.errstate(over="ignore"):
            out[1:] = np.multiply.accumulate(np.full(n, _BASE, dtype=np.uint64))
    return out


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word of texts laid end to end; ``bounds`` has each text's start and the end.

    Words are runs of bytes other than space and \\t \\n \\v \\f \\r, with A-Z in lower case.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_GAPS[data]
    before = np.concatenate([[False], inside[:-1]])
    first_byte = np.zeros(len(data) + 1, dtype=bool)
    first_byte[bounds] = True  # a text's first byte starts a word, whatever stands before it
    starts = np.flatnonzero(inside & (~before | first_byte[:-1]))
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~first_byte[1:-1], [False]])) + 1
    text = np.searchsorted(bounds, starts, side="right") - 1
    # A word is the sum of its bytes' codes times powers of the base by place in the word.
    offset = np.zeros(len(data), dtype=np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    if len(starts):
        offset[starts[0] :] = np.arange(len(data) - starts[0]) - np.repeat(starts - starts[0], lengths)
    offset[~inside] = 0
    with np.errstate(over="ignore"):
        value = _CODES[_LOWER[data]] * _powers(int(offset.max()))[offset]
        value[~inside] = 0
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        return mixed(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64)), text


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text), sorted by text then hash, of the distinct shingles of ``words`` words.

    A text with fewer words is one shingle, a text without words has none.
    """
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    hashes, text = word_hashes(data, bounds)
    if not len(hashes):
        return hashes, text
    counts = np.bincount(text, minlength=len(texts))
    at = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        out = np.zeros(len(hashes), dtype=np.uint64)
        left = counts[text] - at  # words from here to the text's end
        for k in range(words):
            take = np.flatnonzero(left > k)
            out[take] = mixed(out[take] + hashes[take + k], k + 1)
        whole = (left >= words) | (at == 0)
    out, text = out[whole], text[whole]
    order = np.lexsort((out, text))
    out, text = out[order], text[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (text[1:] != text[:-1])
    return out[new], text[new]
