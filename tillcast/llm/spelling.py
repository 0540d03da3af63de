"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

* Words are the letter runs of all texts with their number of occurrences. Runs are spoilt
  by a rule first (``misspelt``), which plants variants of known words.
* A word of length ``L`` contributes two disjoint chunks, its first and its last ``L // 2``
  code points. A word that it may be one edit away from, of length ``L`` or ``L + 1``,
  contributes its positional grams of that length. One edit spoils at most one of the
  chunks, and moves the other by at most one place: the words are joined where a gram equals
  a chunk and stands at most one place from it (grams further off can join nothing and are
  not emitted), and every pair found is verified by its edit distance.
* A chunk that more than ``HOT`` words share would pair all of them with all grams. Its words
  are joined by what is left of them as well: with the chunk in place, the rest holds the
  one edit, so the rests agree after one code point is taken from the same place of both
  (a replacement), or from the longer one alone (an insertion). Every edit leaves the first
  chunk in place from the left or the last from the right, so no pair is lost, and rests that
  agree are pairs but for equal words: a key's pairs grow no faster than the true ones.

Counting runs over texts in Arrow batches; all that follows are DataFrame functions on
distinct words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import text_slices, utf8
from tillcast.session import materialize

# Fixed value: the letters of words.
LETTERS = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, SPOIL = 5, 3, 97
HOT = 64
LONGEST_REST = 64           # rests beyond it are not spelt out; such words share 64 code points
BROADCAST_KEYS = 500_000
HELD_WORDS = 200_000        # sums that a task holds
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def misspelt(run: str, start: int, every: int = SPOIL) -> str:
    """``run`` without the code point ``h % length`` where ``every`` divides ``h``, the unsigned
    CRC-32 of ``<doc_id>:<run>``; ``start`` is that of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = SPOIL) -> DataFrame:
    """``docs(doc_id, text)`` → ``word, n``: the words of at least ``min_length`` code points
    and ``min_count`` occurrences in all texts together. Null and empty texts have none; of a
    null id nothing stands before the colon.

    A task adds up a document's runs, then all its documents', and passes its sums on when
    it holds ``HELD_WORDS`` words; only sums are shuffled."""
    # No edit makes a run longer, so shorter ones are left out before anything else.
    long_runs = re.compile(f"{LETTERS[:-1]}{{{min_length},}}")

    def count(batches):
        total: dict[str, int] = {}

        def sums():
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                              names=["word", "n"])

        for batch in text_slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch), strict=True):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for run, n in Counter(long_runs.findall(text.translate(_FOLD).decode())).items():
                    word = misspelt(run, start, every)
                    if len(word) >= min_length:
                        total[word] = total.get(word, 0) + n
                if len(total) >= HELD_WORDS:
                    yield sums()
                    total.clear()
        yield sums()

    return (docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _without(rest: Column, at: Column) -> Column:
    return F.concat(F.left(rest, at), F.substr(rest, at + 2))


def _places(rest: Column) -> Column:
    return F.when(F.length(rest) > 0, F.sequence(F.lit(0), F.length(rest) - 1)).otherwise(F.array().cast("array<int>"))


def chunks(words: DataFrame) -> DataFrame:
    """``key, part, word``: each word's two chunks, the first (``part`` 0) and the last (1).
    A key is a hash of the word's length, the part and the chunk."""
    q = F.floor(F.length("word") / 2).cast("int")
    both = F.array(F.struct(F.lit(0).alias("part"), F.left("word", q).alias("chunk")),
                   F.struct(F.lit(1).alias("part"), F.right("word", q).alias("chunk")))
    return (words.select("word", F.explode(both).alias("c"))
            .select(F.xxhash64(F.length("word"), "c.part", "c.chunk").alias("key"), "c.part", "word"))


def grams(words: DataFrame) -> DataFrame:
    """``key, part, other, longer, moved``: each word's positional grams, for words of its
    length and (``longer``) of one less, at most one place from that chunk. ``moved``: not
    where an edit outside of the chunk leaves it."""
    rows = (words.select(F.col("word").alias("other"), F.explode(F.array(F.lit(0), F.lit(1))).alias("longer"))
            .withColumn("size", F.length("other") - F.col("longer"))
            .withColumn("q", F.floor(F.col("size") / 2).cast("int"))
            .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("part")))
    at = F.when(F.col("part") == 0, 0).otherwise(F.col("size") - F.col("q"))
    rows = rows.withColumn("at", at).withColumn("p", F.explode(F.sequence(
        F.greatest(F.col("at") - 1, F.lit(0)), F.least(F.col("at") + 1, F.length("other") - F.col("q")))))
    home = F.col("at") + F.when(F.col("part") == 1, F.col("longer")).otherwise(0)
    return rows.select(F.xxhash64("size", "part", F.substr("other", F.col("p") + 1, F.col("q"))).alias("key"), "part",
                       "other", "longer", (F.col("p") != home).alias("moved"))


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs that share a key and are one edit apart; of two words of equal length the smaller
    asks."""
    asks = (F.length("other") > F.length("word")) | (F.col("word") < F.col("other"))
    return (left.join(right, "key").filter(asks).select("word", "other")
            .filter(F.levenshtein("word", "other", 1) == 1))


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``words(word)``, distinct → ``word, other``, each pair of words one edit apart once."""
    left, right = chunks(words), grams(words)
    full = materialize(left.groupBy("key").count().filter(F.col("count") > hot).select("key", F.lit(True).alias("full")),
                       "spelling-hot")
    if full.count() <= BROADCAST_KEYS:
        full = F.broadcast(full)
    # Long rests are joined by their chunk alone.
    rest_length = F.length("word") - F.floor(F.length("word") / 2)
    left = left.join(full, "key", "left").withColumn("full", F.coalesce(F.col("full"), F.lit(False)))
    right = right.join(full, "key", "left").withColumn("full", F.coalesce(F.col("full"), F.lit(False)))
    short = rest_length <= LONGEST_REST
    size = F.length("other") - F.col("longer")
    short_other = size - F.floor(size / 2) <= LONGEST_REST
    plain = _pairs(left.filter(~(F.col("full") & short)).select("key", "word"),
                   right.filter(~(F.col("full") & short_other)).select("key", "other"))

    def rest(word: str, length: Column) -> Column:
        q = F.floor(length / 2).cast("int")
        return F.when(F.col("part") == 0, F.substr(word, q + 1)).otherwise(F.left(word, F.length(word) - q))

    asking = left.filter(F.col("full") & short).withColumn("rest", rest("word", F.length("word")))
    asked = right.filter(F.col("full") & short_other & ~F.col("moved")).withColumn("rest", rest("other", size))
    place = F.explode(_places(F.col("rest"))).alias("place")

    def spelt(rows: DataFrame, word: str, *kind) -> DataFrame:
        return rows.select(F.xxhash64("key", *kind).alias("key"), word)

    left = spelt(asking.select("*", place), "word", F.lit(0), "place", _without(F.col("rest"), F.col("place"))).unionByName(
        spelt(asking, "word", F.lit(1), F.lit(0), F.col("rest")))
    right = asked.select("*", place)
    right = spelt(right, "other", "longer", F.when(F.col("longer") == 0, F.col("place")).otherwise(0),
                  _without(F.col("rest"), F.col("place")))
    return plain.unionByName(_pairs(left, right)).distinct()


def roots(links: DataFrame) -> DataFrame:
    """``links(word, form)``, without circles → ``word, root``: the last form that is reached.
    Every round doubles the steps taken."""
    now = links.select("word", F.col("form").alias("root"))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = materialize(now.join(step, "root", "left")
                          .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                          "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, every: int = SPOIL,
             hot: int = HOT) -> DataFrame:
    """``docs(doc_id, text, …)`` → one row per word: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order) where
    that is at least twice the word's own, else null; ``root`` is where forms lead to in the
    end, the word itself without any. ``n`` at least doubles on the way, so there are no
    circles and at most 62 steps. Rows count as often as they occur; an empty table gives no
    rows; further columns are not read."""
    words = materialize(word_counts(docs, min_length, min_count, every), "spelling-words")
    pairs = near_pairs(words.select("word"), hot)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other")))
    first = F.min(F.struct((-F.col("n")).alias("less"), F.col("other"))).alias("first")
    near = (both.join(words.select(F.col("word").alias("other"), "n"), "other").groupBy("word")
            .agg(F.count("*").alias("n_near"), first))
    near = (words.join(near, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    (-F.col("first.less")).alias("other_n"), F.col("first.other").alias("other"))
            .withColumn("follows", F.coalesce(F.col("other_n") >= 2 * F.col("n"), F.lit(False)))
            .select("word", "n", "n_near", F.when(F.col("follows"), F.col("other")).alias("form"),
                    F.when(F.col("follows"), F.col("other_n")).alias("form_n")))
    near = materialize(near, "spelling-forms")
    last = roots(near.filter("form IS NOT NULL").select("word", "form"))
    return (near.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
