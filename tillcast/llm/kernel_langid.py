"""Language identification by a string kernel.

The kernel is the blended-spectrum presence kernel: the number of byte n-grams (n = 1..3,
letters folded to lower case, everything else to one blank) that two texts both contain,
normalised by their own counts. A few landmark documents per language span the Nyström
space; one-versus-rest kernel ridge regression is solved in it. Texts are scored in
batches: a 0/1 matrix of the n-grams present times the landmarks' matrix gives the kernel
rows, times one weight matrix the languages' outputs.

Some output is always the largest, however strange the text. Whether a text is in a
learned language at all is told by its 3-grams (``claimed``): the mean share of a
language's landmarks that hold them, against what is usual for the language's own sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import SLICE_BYTES, release, setting, text_slices, utf8
from tillcast.session import materialize

ORDERS = (1, 2, 3)
# Labelled documents per language used for fitting (those of the smallest id hash), and
# how many of them are landmarks.
FIT_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 600, 32
MAX_BROADCAST_ROWS = 200_000
RIDGE, JITTER = 1e-2, 1e-6
UNDETERMINED = "und"
_BATCH = 256
# Batches of one slice: what a task holds does not follow the length of its texts.
_BATCHES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))
# A language claims a text whose 3-grams its landmarks hold at least CLAIM times as often as
# those of its own sample's median text of that length; medians are taken at these lengths.
CLAIM, CUTS = 0.4, (32, 128, 512, 2048)
_THREE = 1 << 16    # codes of 3-grams begin here

_FOLD = np.frombuffer(bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower(), np.uint8)


@dataclass
class KernelModel:
    languages: list[str]
    grams: np.ndarray = field(repr=False)        # codes of the n-grams, ascending
    presence: np.ndarray = field(repr=False)     # n-grams × landmarks, 0/1
    sizes: np.ndarray = field(repr=False)        # n-grams present per landmark
    weights: np.ndarray = field(repr=False)      # landmarks + 1 × languages
    shares: np.ndarray = field(repr=False)       # n-grams + 1 × languages, share of landmarks with it
    least: np.ndarray = field(repr=False)        # CUTS × languages, least mean share that claims


def gram_codes(text: bytes) -> np.ndarray:
    """Codes of all n-grams of a text (blanks at both ends), repeats included."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    folded = _FOLD[raw].astype(np.int32)
    # Runs of blanks count as one.
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    folded = folded[keep]
    out, code = [folded], folded
    for _ in ORDERS[1:]:
        if len(code) < 2:
            break
        code = (code[:-1] << 8) | folded[len(folded) - len(code) + 1:]
        # An n-gram's leading byte is never 0, so codes of different n never meet.
        out.append(code)
    return np.concatenate(out)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode(errors="replace"))


@dataclass
class GramTable:
    """n-gram code → its column, ``other`` for codes of no n-gram. Columns lie in pages of the 256
    codes that differ in the last byte; the codes without an n-gram share one page, so that the
    table grows with the n-grams and not with the possible codes."""

    pages: np.ndarray      # code without its last byte → where its page begins
    columns: np.ndarray
    other: int

    @classmethod
    def of(cls, grams: np.ndarray) -> GramTable:
        held, page = np.unique(grams >> 8, return_inverse=True)
        pages = np.zeros(1 << (8 * (len(ORDERS) - 1)), np.int32)
        pages[held] = np.arange(1, len(held) + 1, dtype=np.int32) << 8
        columns = np.full((len(held) + 1) << 8, len(grams), np.int32)
        columns[((page + 1) << 8) | (grams & 0xFF)] = np.arange(len(grams), dtype=np.int32)
        return cls(pages, columns, len(grams))

    def __getitem__(self, codes: np.ndarray) -> np.ndarray:
        return self.columns[self.pages[codes >> 8] | (codes & 0xFF)]


_TABLES: dict[int, GramTable] = {}


def _table(grams: np.ndarray) -> GramTable:
    """The table of these n-grams (one is kept per worker)."""
    key = hash(grams.tobytes())
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = GramTable.of(grams)
    return _TABLES[key]


def kernel_rows(texts: list[bytes], grams: np.ndarray, presence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Kernel of each text with each landmark (batched matrix product)."""
    table, rows = _table(grams), []
    for at in range(0, len(texts), _BATCH):
        part = texts[at:at + _BATCH]
        seen = np.zeros((len(part), len(grams) + 1), dtype=np.float32)
        for i, text in enumerate(part):
            seen[i, table[gram_codes(text)]] = 1.0
        seen = seen[:, :-1]
        own = seen.sum(axis=1)
        rows.append((seen @ presence) / np.sqrt(np.maximum(own[:, None] * sizes, 1.0)))
    return np.concatenate(rows).astype(np.float64) if rows else np.zeros((0, len(sizes)))


def mean_share(text: bytes, table: GramTable, shares: np.ndarray) -> np.ndarray:
    """Per language: the mean of ``shares`` over the text's distinct 3-grams."""
    codes = np.unique(gram_codes(text))
    codes = codes[np.searchsorted(codes, _THREE):]
    return shares[table[codes]].mean(axis=0) if len(codes) else np.zeros(shares.shape[1])


def fit_rows(docs: DataFrame, usable, per_language: int) -> DataFrame:
    """The bounded sample: per language the ``per_language`` labelled documents of the
    smallest hash. Only ids and hashes are ranked; the limit is applied before the shuffle.
    Rows that repeat an id and language count once, however many they are."""
    ranked = (docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
              .select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct()
              .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
              .filter(F.col("r") <= per_language).select("doc_id", "lang", "r"))
    ranked = materialize(ranked, "langid-sample")
    # Bounded by per_language rows a language; its size is checked all the same.
    if ranked.count() <= MAX_BROADCAST_ROWS:
        ranked = F.broadcast(ranked)
    return (docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
            .join(ranked, ["doc_id", "lang"]).groupBy("doc_id", "lang", "r").agg(F.min("text").alias("text")))


def fit(docs: DataFrame, usable=None, per_language: int = FIT_PER_LANGUAGE,
        landmarks: int = LANDMARKS_PER_LANGUAGE) -> KernelModel:
    """Learn from ``docs(doc_id, lang, text)`` where ``usable`` (a Column) holds and ``lang``
    is known. The sample is at most ``per_language`` documents per language; with fewer
    than 1,000 of them the ranking stays partial before its shuffle. No usable row gives
    a model without languages, which answers ``und``."""
    spark = docs.sparkSession
    rows = fit_rows(docs, F.lit(True) if usable is None else usable, per_language)

    def grams_of(batches):
        for batch in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([np.unique(gram_codes(t)).tolist() for t in utf8(batch)],
                                                            pa.list_(pa.int32()))],
                names=["doc_id", "lang", "grams"])
            release()

    marks = rows.filter(F.col("r") <= landmarks).select("doc_id", "lang", "text")
    with setting(spark, *_BATCHES):
        marks = marks.mapInArrow(grams_of, "doc_id long, lang string, grams array<int>").toArrow().to_pylist()
    marks.sort(key=lambda m: (m["lang"], m["doc_id"], m["grams"]))
    languages = sorted({m["lang"] for m in marks})
    if not languages:
        empty = np.zeros(0, np.int32)
        return KernelModel([], empty, np.zeros((0, 0), np.float32), empty, np.zeros((1, 0)),
                           np.zeros((1, 0)), np.zeros((len(CUTS), 0)))
    # n-grams that two landmarks share; one that a single text has says nothing of others.
    codes, counts = np.unique(np.concatenate([m["grams"] for m in marks]), return_counts=True)
    grams = codes[counts > 1 if (counts > 1).any() else counts > 0].astype(np.int32)
    presence = np.zeros((len(grams), len(marks)), np.float32)
    for j, m in enumerate(marks):
        at = np.searchsorted(grams, m["grams"])
        at = at[(at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == m["grams"])]
        presence[at, j] = 1.0
    sizes = presence.sum(axis=0)
    member = np.array([m["lang"] for m in marks])[:, None] == np.array(languages)[None, :]
    held, marked = np.vstack([presence @ member, np.zeros((1, len(languages)))]), member.sum(axis=0)
    shared = spark.sparkContext.broadcast((grams, presence, sizes, held, marked))

    def kernels(batches):
        grams, presence, sizes, held, marked = shared.value
        for batch in text_slices(batches):
            texts, usual, table = utf8(batch), [], _table(grams)
            k = kernel_rows(texts, grams, presence, sizes)
            for text, lang, mark in zip(texts, batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                at = languages.index(lang)
                # A landmark is held against the others of its language.
                others = np.maximum(held[:, [at]] - mark, 0) / max(1, marked[at] - mark)
                usual.append([float(mean_share(text[:c], table, others)[0])
                              if (c == CUTS[0] or len(text) >= c) and marked[at] > mark else None for c in CUTS])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(k.tolist(), pa.list_(pa.float64())),
                 pa.array(usual, pa.list_(pa.float64()))], names=["doc_id", "lang", "k", "usual"])
            release()

    sample = rows.select("doc_id", "lang", "text", (F.col("r") <= landmarks).cast("int").alias("mark"))
    with setting(spark, *_BATCHES):
        sample = (sample.mapInArrow(kernels, "doc_id long, lang string, k array<double>, usual array<double>")
                  .toArrow().to_pylist())
    sample.sort(key=lambda s: (s["doc_id"], s["lang"], s["k"]))
    k = np.array([s["k"] for s in sample])
    y = np.where(np.array([s["lang"] for s in sample])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    between = (presence.T @ presence).astype(np.float64) / np.sqrt(np.maximum(np.outer(sizes, sizes), 1.0))
    value, vector = np.linalg.eigh(between)
    root = (vector / np.sqrt(np.maximum(value, JITTER))) @ vector.T
    phi = np.hstack([k @ root, np.ones((len(k), 1))])
    # Rows weigh so that every language counts alike.
    weight = 1.0 / (y > 0).sum(axis=0)[np.argmax(y, axis=1)]
    a = phi.T @ (phi * weight[:, None]) + RIDGE / len(k) * np.eye(phi.shape[1])
    solved = np.linalg.solve(a, phi.T @ (y * weight[:, None]))
    return KernelModel(languages, grams, presence, sizes, np.vstack([root @ solved[:-1], solved[-1:]]),
                       held / marked, _least(sample, languages))


def _least(sample: list[dict], languages: list[str]) -> np.ndarray:
    """Per length and language ``CLAIM`` times the sample's median. A length that no text of the
    language has takes the next shorter one's; a language of one document, which cannot be held
    against others, the smallest of the other languages (0 without any)."""
    out = np.full((len(CUTS), len(languages)), np.nan)
    for j, lang in enumerate(languages):
        for i in range(len(CUTS)):
            own = [s["usual"][i] for s in sample if s["lang"] == lang and s["usual"][i] is not None]
            out[i, j] = CLAIM * np.median(own) if own else out[i - 1, j] if i else np.nan
    known = ~np.isnan(out[0])
    out[:, ~known] = out[:, known].min(axis=1, keepdims=True) if known.any() else 0.0
    return out


def _outputs(model: KernelModel, texts: list[bytes]) -> np.ndarray:
    return kernel_rows(texts, model.grams, model.presence, model.sizes) @ model.weights[:-1] + model.weights[-1]


def claimed(docs: DataFrame, model: KernelModel) -> DataFrame:
    """The rows of ``docs(text, …)``, all columns, whose language can be told: with a letter, and
    with 3-grams of a mean share that reaches the least one of the best language for the
    text's length. Unlike the outputs' height this border does not depend on the number of
    languages. Each row by itself; narrow. Only the texts go to the Python workers and only
    the verdicts come back."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def claims(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own: KernelModel = shared.value
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            yield pa.array(chain.from_iterable(_claims(own, utf8(part)) for part in text_slices([batch])), pa.bool_())
            release()

    return docs.filter(claims(F.col("text").cast("string")))


def _claims(model: KernelModel, texts: list[bytes]) -> list[bool]:
    keep = [bool(model.languages) and has_letter(text) for text in texts]
    if model.languages:
        cuts, table = np.log(CUTS), _table(model.grams)
        columns = [model.shares[:, [j]] for j in range(len(model.languages))]
        for i, (text, j) in enumerate(zip(texts, _outputs(model, texts).argmax(axis=1).tolist(), strict=True)):
            if keep[i]:
                share = mean_share(text, table, columns[j])[0]
                keep[i] = bool(share >= np.interp(np.log(len(text)), cuts, model.least[:, j]))
    return keep


def predict(docs: DataFrame, model: KernelModel) -> DataFrame:
    """``docs(doc_id, text, …)`` → ``(doc_id, lang_pred, score, margin)``, one row per input
    row; narrow. Only the text is looked at. A null text or one without a letter is
    ``und`` with score 0. ``score`` maps the best language's output from -1..1 to 0..1;
    ``margin`` is its lead over the second."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own: KernelModel = shared.value
        for batch in text_slices(batches):
            texts = utf8(batch)
            lang, score, margin = [UNDETERMINED] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            if own.languages:
                out = _outputs(own, texts)
                best = out.argmax(axis=1)
                ranked = np.sort(out, axis=1)
                for i, text in enumerate(texts):
                    if has_letter(text):
                        lang[i] = own.languages[best[i]]
                        score[i] = float((np.clip(ranked[i, -1], -1, 1) + 1) / 2)
                        margin[i] = float(ranked[i, -1] - ranked[i, -2]) if len(own.languages) > 1 else 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang), pa.array(score), pa.array(margin)],
                                             names=["doc_id", "lang_pred", "score", "margin"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double, margin double")
