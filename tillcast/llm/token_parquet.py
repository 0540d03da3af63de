"""Token-ID output: documents encoded by a public tokenizer and written as Parquet list
columns with controlled row groups, pages and encodings.

Format of a token table (a folder):

* ``tokens/`` one row per document, ascending ``doc_id`` over the files and in each
  file: ``doc_id``, ``file_start`` (ids before the document in its file), ``n_tokens``,
  ``ids`` (list of int32). ``ids`` is dictionary-encoded (a vocabulary fits one
  dictionary page); the metadata columns have no dictionary and so, with version 2 pages,
  are delta-encoded. Small row groups and pages, and the column and page indexes Parquet
  writes for them, let a reader fetch a range of documents, or the metadata alone.
* ``manifest/`` one row per file: its number, the ids and documents in it, and ``base``,
  the ids of all files before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import file_number, running_total, text_slices, utf8

END_ID = 1
TOKEN_SCHEMA = "doc_id long, file_start long, n_tokens long, ids array<int>"
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 1000

# Encoded words and units of words a worker process remembers, none longer than LONGEST_KEPT bytes (those are kept for
# a slice); those of the generation before are kept until as many new ones are known.
WORD_MEMORY, UNIT_MEMORY, LONGEST_KEPT = 500_000, 125_000, 48
_PUNCTUATION = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_WORDS: dict[str, Words] = {}
_TOKENIZERS: dict[str, tuple] = {}


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> list[str]:
    """The printable character that byte-level tokenizers write for each byte: printable
    Latin-1 stands for itself, the others follow from U+0100 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in plain else chr(0x100 + extra))
        extra += b not in plain
    return out


def word_encoder(path: str) -> Callable[[bytes], bytes]:
    """``word (UTF-8, no ASCII white space) → its ids as little-endian 32-bit integers``.

    For tokenizers that drop white space: a text's ids are then its words' ids in order.
    Any word goes through the library's whole ``encode``; a word of plain lower-case
    letters, with or without punctuation behind it, is one or two units of the
    library's splitting rule and goes straight to the library's model.
    """
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        probe = tok.encode("ab  c\n d", add_special_tokens=False).ids
        apart = [i for w in ("ab", "c", "d") for i in tok.encode(w, add_special_tokens=False).ids]
        if probe != apart:
            raise ValueError("this tokenizer keeps white space; words cannot be encoded apart")
        letters = str.maketrans(dict(enumerate(_byte_letters())))
        model = tok.model

        def spelled(piece: bytes) -> bytes:
            # ASCII letters stand for themselves.
            text = piece.decode() if piece.isalpha() else piece.decode("latin-1").translate(letters)
            return _packed([t.id for t in model.tokenize(text)])

        _TOKENIZERS[path] = (tok, Words(spelled, UNIT_MEMORY))
    tok, units = _TOKENIZERS[path]
    unit = units.__getitem__

    def encode(word: bytes) -> bytes:
        core = word.rstrip(_PUNCTUATION)
        if core:
            if core.isalpha():                                  # ASCII letters only
                lower = core.lower()
            else:
                text = core.decode()
                # Latin letters up to U+024F are precomposed and lower-case one to one (but U+0130).
                plain = text.isalpha() and max(text) < "ɐ" and "İ" not in text
                lower = text.lower().encode() if plain else None
            if lower is not None:
                return unit(lower) + unit(word[len(core):]) if len(core) < len(word) else unit(lower)
        return _packed(tok.encode(word.decode(), add_special_tokens=False).ids)

    return encode


class Words(dict):
    """Word → its ids. A missing word comes from the generation before, or is encoded."""

    def __init__(self, encode: Callable[[bytes], bytes], memory: int):
        super().__init__()
        self.encode, self.memory, self.older, self.long = encode, memory, {}, []

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
            if len(word) > LONGEST_KEPT:
                self.long.append(word)
        self[word] = ids
        return ids

    def forget(self) -> None:
        """Long words, and the generation before once there are enough new words."""
        for word in self.long:
            del self[word]
        self.long = []
        if len(self) >= self.memory:
            self.older = {}                                     # not three at a time
            self.older = dict(self)
            self.clear()


def encode_texts(texts: list[bytes], path: str, end_id: int | None = END_ID) -> list[bytes]:
    """Ids of whole texts as little-endian 32-bit integers, each with ``end_id`` behind. Every
    distinct word of the texts is encoded once."""
    if path not in _WORDS:
        _WORDS[path] = Words(word_encoder(path), WORD_MEMORY)
    words = _WORDS[path]
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    try:
        return [b"".join(map(words.__getitem__, text.split())) + end for text in texts]
    finally:
        words.forget()
        _TOKENIZERS[path][-1].forget()


def encoded(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """``docs(doc_id, text)`` → ``TOKEN_SCHEMA`` in the order of the rows given;
    ``file_start`` runs within each partition. Null text is empty text."""
    def run(batches):
        start = 0
        for batch in text_slices(batches):
            ids = encode_texts(utf8(batch), path, end_id)
            counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(start + ends - counts), pa.array(counts),
                 pa.ListArray.from_arrays(pa.array(offsets), flat)],
                names=["doc_id", "file_start", "n_tokens", "ids"])
            start += int(ends[-1])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, TOKEN_SCHEMA)


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int | None = END_ID) -> None:
    """Encode ``docs`` and write them as a token table in ``folder``.

    Rows are range-partitioned by ``doc_id`` (no file or task holds more than its
    share) and sorted (equal ids by a hash of the text, a null id first), then encoded in the writing
    task. An empty input writes an empty table.
    """
    spark = docs.sparkSession
    # Ranges are drawn from ids and hashes alone: no text goes to the driver.
    ordered = (docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"))
               .sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    options = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0",
               "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES,
               "parquet.page.row.count.limit": PAGE_ROWS, "parquet.enable.dictionary": "true",
               **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "file_start", "n_tokens")}}
    encoded(ordered, path, end_id).write.options(**options).parquet(f"{folder}/tokens")
    files = (spark.read.schema(TOKEN_SCHEMA).parquet(f"{folder}/tokens")
             .select(file_number().alias("file"), "n_tokens")
             .groupBy("file").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs")))
    running_total(files, "file", "n_tokens").write.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a token table, or of the documents with
    ``low <= doc_id <= high``. Columns not used and pages outside the range are not read."""
    rows = spark.read.schema(TOKEN_SCHEMA).parquet(f"{folder}/tokens").withColumn("file", file_number())
    if low is not None:
        rows = rows.filter(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.filter(F.col("doc_id") <= high)
    return _with_start(rows, spark.read.parquet(f"{folder}/manifest"))


def _with_start(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    return (rows.join(manifest.select("file", "base"), "file")
            .withColumn("start", F.col("base") + F.col("file_start")).drop("file", "base", "file_start"))


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` computed from the stored files."""
    def run(batches):
        for batch in batches:
            ids = batch.column(3)
            flat = memoryview(ids.flatten().to_numpy().astype("<u4", copy=False)).cast("B")
            ends = np.cumsum(ids.value_lengths().to_numpy()) * 4
            crc, at = [], 0
            for end in ends.tolist():
                crc.append(zlib.crc32(flat[at:end]))
                at = end
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 4)), pa.array(crc, pa.int64())],
                                             names=["doc_id", "file_start", "n_tokens", "file", "ids_crc32"])

    rows = spark.read.schema(TOKEN_SCHEMA).parquet(f"{folder}/tokens").withColumn("file", file_number())
    digests = rows.mapInArrow(run, "doc_id long, file_start long, n_tokens long, file long, ids_crc32 long")
    return _with_start(digests, spark.read.parquet(f"{folder}/manifest")) \
        .select("doc_id", "start", "n_tokens", "ids_crc32")
