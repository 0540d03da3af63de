"""Sets of word shingles as 64-bit hashes, computed for a batch of whole texts at once."""

from __future__ import annotations

import numpy as np

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95          # odd: has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
# Text bytes hashed at a time.
BLOCK_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, A-Z folded, and the words per text. A word is a run
    of bytes other than blank, tab, line feed, VT, FF and CR. About ``BLOCK_BYTES`` are hashed
    at a time, cut at a blank: a byte takes some 40 bytes of memory meanwhile."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    words, starts, at = [], [], 0
    while at < len(raw):
        end = at + BLOCK_BYTES
        while end < len(raw) and not _BLANK[raw[end - 1]]:
            end += 1
        value, start = _block_words(raw[at:end])
        words.append(value)
        starts.append(start + at)
        at = end
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    owner_ends = np.searchsorted(np.concatenate(starts), np.cumsum(sizes))
    return np.concatenate(words), np.diff(np.concatenate([[0], owner_ends]))


def _block_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of bytes that end with a blank."""
    blank = _BLANK[raw]
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    if not blank[0]:
        starts = np.concatenate([[0], starts])
    # Sum of byte value × base**position between a word's ends, shifted to position 0.
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[_FOLD[raw]] * _powers(_BASE, len(raw)), out=sums[1:])
    value = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), starts


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text: ``(hashes, counts)``, ascending hashes per text,
    texts after one another. With fewer than k words the whole sequence is the one
    shingle; a text without words has an empty set."""
    values, counts, start, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= BLOCK_BYTES or i + 1 == len(texts):
            value, count = _block_sets(texts[start:i + 1], k)
            values.append(value)
            counts.append(count)
            start, size = i + 1, 0
    return np.concatenate(values), np.concatenate(counts)


def _block_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    words, counts = word_hashes(texts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    shingles = np.maximum(counts - k + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), shingles)
    begin = np.repeat(first - np.concatenate([[0], np.cumsum(shingles)])[:-1], shingles) + np.arange(len(owner))
    length = np.minimum(counts, k)[owner]
    value = np.zeros(len(owner), np.uint64)
    for j in range(k):
        has = length > j
        value[has] = mix(value[has] * np.uint64(0x9FB21C651E98DF25) + words[begin[has] + j] + np.uint64(j + 1))
    at = 0
    for n in shingles.tolist():
        value[at:at + n].sort()
        at += n
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[fresh], np.bincount(owner[fresh], minlength=len(texts)).astype(np.int64)
