"""Words and word shingles of whole texts as hashes, in numpy over Arrow buffers."""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marinelake.llm.common import spread, value_bytes

SHINGLE = 5
_NO_WORD = r"[^\p{L}\p{N}\p{M}]+"
_BLOCK = 1 << 20
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(int(_rng.integers(1 << 62, 1 << 63)) | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))

#: Bytes with ASCII capitals as small letters and other ASCII characters as blanks.
_PLAIN = np.array([ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)] + list(range(128, 256)), np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case texts with one space in place of what is no letter, mark or digit."""
    return value_bytes(pc.replace_substring_regex(pc.utf8_lower(texts), _NO_WORD, " "))


def _edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end; a text's end ends its word."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    inside = data[lo:hi] != 32
    opens, closes = inside.copy(), inside.copy()
    cut = offsets[1:-1] - lo
    cut = cut[(cut > 0) & (cut < len(inside))]
    joined = np.ones(max(len(inside), 1), bool)
    joined[cut] = False
    if len(inside):
        opens[1:] &= ~(inside[:-1] & joined[1 : len(inside)])
        closes[:-1] &= ~(inside[1:] & joined[1 : len(inside)])
    return np.flatnonzero(opens) + lo, np.flatnonzero(closes) + lo + 1


def word_hashes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the offset of each text in them."""
    data, offsets = word_bytes(texts)
    starts, ends = _edges(data, offsets)
    return _hashes(data, starts, ends), np.searchsorted(starts, offsets)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The powers of ``base`` from 0 to ``n``."""
    if n <= _BLOCK:
        return _block_powers(base)[: n + 1]
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


@cache
def _block_powers(base: np.uint64) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(_BLOCK, base, np.uint64)]))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):  # blocks of whole words
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _BLOCK, "right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        n = hi - lo
        power, back = _powers(_STEP, n), _powers(_BACK, n)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data[lo:hi]] * power[:n])])
        a, b = starts[first:last] - lo, ends[first:last] - lo
        out[first:last] = mix((sums[b] - sums[a]) * back[a])
        first = last
    return out


def placed_words(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words with their places: hash, first byte and byte after the last
    within the text, and the offset of each text in the words.

    Words are runs of ASCII letters and digits and of characters beyond ASCII other
    than common blanks and punctuation. Case does not count, but for texts that small
    letters would make longer or shorter: there it does beyond ASCII."""
    small = pc.utf8_lower(texts)
    texts = pc.if_else(pc.equal(pc.binary_length(small), pc.binary_length(texts)), small, texts)
    data, offsets = value_bytes(texts)
    lo, hi = int(offsets[0]), int(offsets[-1])
    own = _PLAIN[data[lo:hi]]
    if len(own) and own.max() > 127:
        second = np.append(own[1:], 0)
        two = (own == 0xC2) & (second >= 0xA0) & (second <= 0xBF)
        three = ((own == 0xE2) & ((second == 0x80) | (second == 0x81))) | ((own == 0xE3) & (second == 0x80))
        at = np.concatenate([np.flatnonzero(two), np.flatnonzero(two) + 1, *(np.flatnonzero(three) + i for i in range(3))])
        own[at[at < len(own)]] = 32
    starts, ends = _edges(own, offsets - lo)
    words = np.searchsorted(starts, offsets - lo)
    base = np.repeat(offsets[:-1] - lo, np.diff(words))
    return _hashes(own, starts, ends), starts - base, ends - base, words


def shingles(words: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``size`` words of a text, in order, and the offset of
    each text in them. A text of fewer words has one shingle, of all of them."""
    counts = np.diff(offsets)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(n)])
    at = spread(offsets[:-1], n)
    value = np.zeros(len(at), np.uint64)
    limit = np.repeat(offsets[1:], n)
    for j in range(size):
        there = at + j < limit
        word = np.where(there, words[np.minimum(at + j, max(len(words) - 1, 0))], np.uint64(j + 1)) if len(at) else value
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + word)
    return value, ends


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values of each text, sorted, how often each is there, and offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return values[at], np.diff(np.append(at, len(values))), np.searchsorted(owner[at], np.arange(len(offsets)))
