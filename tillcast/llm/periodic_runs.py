"""Periodic runs of words by dyadic square catching.

A run is a stretch of words that repeats itself with its smallest period, at least twice,
and cannot be longer. Words are appended to a text one after another; when a block of
``B = 2**k`` words is completed, a catcher is set on it, which watches for the block to come
again ``2B`` to ``4B - 1`` words later. A square of such a period holds a completed block in
its first half, so its catcher sees it. Each word appended then advances the comparison of
the text with itself at that distance, forwards and (over the words before the block)
backwards; the stretch where both agree is as long as the squares of that period go on, and
squares caught by neighbouring blocks, or by multiples of a period, merge into one run.

The catchers of a level work on all texts of a slice as arrays:

* Blocks are named exactly, not by hashes: the name of ``2B`` words is the number of the
  pair of names of its halves, found anew on each level. A block that stands once in the
  slice has no name, takes no part in higher levels and costs nothing there.
* A comparison that would advance by a whole block is the next block's, so the catchers of
  one distance form chains, and only the ends of chains advance, by names of ever smaller
  blocks: at most one step per level.
* Blocks of one and two words (periods up to 7) stand too often for names to help: their
  catchers compare each word appended.

Work is near linear in a text's words times the logarithm of the longest repeated block.
Texts are independent: the operator is one narrow stage without a shuffle. Memory is that
of a slice of ``SLICE_BYTES`` of text; one longer text is handled alone, whole.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import text_slices, utf8

SLICE_BYTES = 1 << 20
MIN_LENGTH = 12
_DIRECT = 8                 # periods below it are compared word by word

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _next_names(names: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the blocks of ``2 * block`` words from those of ``block`` words, and the places
    that have one. Blocks that stand once get a negative number of their own."""
    n = len(names)
    out = -1 - np.arange(n, dtype=np.int64)
    at = np.flatnonzero(names[:max(n - block, 0)] >= 0)
    at = at[names[at + block] >= 0]
    code, _ = pd.factorize(names[at] * np.int64(n + 1) + names[at + block])
    again = np.bincount(code)[code] > 1 if len(code) else np.zeros(0, bool)
    out[at[again]] = code[again]
    return out, at[again]


def _catch(names: np.ndarray, at: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, distance)`` of the completed blocks that come again ``2 * block`` to
    ``4 * block - 1`` words later; ``at`` are the places of named blocks."""
    n = np.int64(len(names))
    keys = np.sort(names[at] * n + at)
    own = at[at % block == 0]
    base = names[own] * n
    lo = np.searchsorted(keys, base + np.minimum(own + 2 * block, n))
    hi = np.searchsorted(keys, base + np.minimum(own + 4 * block, n))
    count = np.maximum(hi - lo, 0)
    place = np.repeat(own, count)
    index = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    return place, keys[index] % n - place


def _advance(levels: list[np.ndarray], place: np.ndarray, gap: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains of catchers of one distance, and how far their comparisons go on: starts and
    ends of the words that equal those ``gap`` later, and the chains' gaps."""
    order = np.lexsort((place, gap))
    place, gap = place[order], gap[order]
    first = np.ones(len(place), bool)
    first[1:] = (gap[1:] != gap[:-1]) | (place[1:] != place[:-1] + block)
    last = np.append(first[1:], True)
    start, end, gap = place[first], place[last] + block, gap[first]
    n = len(levels[0])
    for k in range(len(levels) - 1, -1, -1):
        step, names = 1 << k, levels[k]
        back = np.maximum(start - step, 0)
        start = np.where((start >= step) & (names[back] == names[back + gap]), start - step, start)
        ahead = np.minimum(end, n - 1)
        there = np.minimum(ahead + gap, n - 1)
        end = np.where((end + gap + step <= n) & (names[ahead] == names[there]), end + step, end)
    return start, end, gap


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """The runs of ``words`` (numbers from 0) as rows ``start, length, period`` by start, then
    period."""
    words = np.asarray(words, dtype=np.int64)
    n = len(words)
    found = []
    for gap in range(1, min(_DIRECT, n)):
        start, end = _stretches(words[:-gap] == words[gap:])
        found.append((start, end, np.full(len(start), gap)))
    names, block, below = words, 1, []
    while 3 * block <= n:       # a block twice as long, and again that much later
        below.append(names)
        names, at = _next_names(names, block)
        block *= 2
        if not len(at):
            break
        if 2 * block >= _DIRECT:
            place, gap = _catch(names, at, block)
            if len(place):
                found.append(_advance(below, place, gap, block))
    if not found:
        return np.zeros((0, 3), np.int64)
    start, end, gap = (np.concatenate(x) for x in zip(*found, strict=True))
    # Words that equal those ``gap`` later: the stretch repeats itself from its start on.
    length = end - start + gap
    keep = length >= np.maximum(min_length, 2 * gap)
    start, length, gap = start[keep], length[keep], gap[keep]
    # Multiples of a period give the same stretch: the smallest stays.
    order = np.lexsort((gap, length, start))
    start, length, gap = start[order], length[order], gap[order]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    rows = np.stack([start[fresh], length[fresh], gap[fresh]], axis=1)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def repeated(n: int, seed: int) -> np.ndarray:
    """The places that the words of a text of ``n`` words are taken from: every tenth text
    (by ``seed``) goes on in circles from some word on."""
    at = np.arange(n)
    g = seed // 10
    if seed % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def _texts_runs(ids: np.ndarray, bounds: np.ndarray, min_length: int) -> list[np.ndarray]:
    """Runs of each text; text ``i`` has the words ``bounds[i]`` to ``bounds[i + 1]``. A word
    of its own between two texts keeps comparisons within a text."""
    count = len(bounds) - 1
    own = np.repeat(np.arange(count), np.diff(bounds))
    joined = np.empty(len(ids) + count, np.int64)
    top = int(ids.max()) + 1 if len(ids) else 0
    joined[np.arange(len(ids)) + own] = ids
    joined[bounds[1:] + np.arange(count)] = top + np.arange(count)
    rows = find_runs(joined, min_length)
    begin = bounds[:-1] + np.arange(count)
    text = np.searchsorted(begin, rows[:, 0], side="right") - 1
    rows[:, 0] -= begin[text]
    return np.split(rows, np.searchsorted(text, np.arange(1, count)))


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def report(docs: DataFrame, min_length: int = MIN_LENGTH, disturb: bool = True) -> DataFrame:
    """``docs(doc_id, text, …)`` → ``SCHEMA``, one row per document: the number of its runs,
    its longest (ties: smallest start, then period; nulls without any), a digest of all, and
    one of the text without the words that a run repeats after its first period.

    Words are runs of characters other than blank, tab, line feed, VT, FF and CR. With
    ``disturb`` the words of every tenth document are made to repeat (``repeated``), by the
    CRC-32 of its id. Null and empty texts have no words. A null id is not disturbed; repeated
    rows and ids are handled each for itself."""
    def run(batches):
        for batch in text_slices(batches, limit=SLICE_BYTES):
            ids_column = batch.column(0)
            texts = [t.split() for t in utf8(batch)]
            counts = np.array([len(t) for t in texts], dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            flat = [w for t in texts for w in t]
            ids = (pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
                   if flat else np.zeros(0, np.int64))
            if disturb:
                for i, doc in enumerate(ids_column.to_pylist()):
                    seed = None if doc is None else zlib.crc32(str(doc).encode())
                    if seed is not None and seed % 10 == 0 and counts[i]:
                        at = repeated(int(counts[i]), seed)
                        lo, hi = bounds[i], bounds[i + 1]
                        ids[lo:hi] = ids[lo:hi][at]
                        texts[i] = [texts[i][j] for j in at.tolist()]
            out = []
            for words, rows in zip(texts, _texts_runs(ids, bounds, min_length), strict=True):
                best = (None, None, None, None)
                if len(rows):
                    s, m, p = rows[np.lexsort((rows[:, 2], rows[:, 0], -rows[:, 1]))[0]].tolist()
                    best = (s, m, p, 1000 * m // p)
                    # Dropped words: a run's, after its first period.
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, rows[:, 0] + rows[:, 2], 1)
                    np.add.at(depth, rows[:, 0] + rows[:, 1], -1)
                    words = [words[j] for j in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
                lines = "".join(f"{s},{m},{p}\n" for s, m, p in rows.tolist())
                out.append((len(rows), *best, _hex(lines.encode()), _hex(b" ".join(words))))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [ids_column, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, SCHEMA)
