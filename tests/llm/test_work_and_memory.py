"""Bounds on the work and memory of operators that once went beyond their limits."""

import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
from public_tokenizers import path as tokenizer  # noqa: E402

from tillcast.llm import kernel_langid, ngram_jaccard, piece_viterbi, token_parquet  # noqa: E402


def peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_keys_of_a_part_are_matched_in_little_memory():
    rng = np.random.default_rng(3)
    rows, keys, owners = [], [], []
    for batch in range(10):
        key = np.concatenate([rng.integers(0, 1 << 63, 100_000).astype(np.uint64) * np.uint64(2),
                              np.arange(50, dtype=np.uint64) << np.uint64(57)])
        ids = np.arange(len(key), dtype=np.int64) + batch * 10**6
        keys.append(key)
        owners.append(ids)
        rows.append((batch, key.tobytes(), ngram_jaccard._ascending(ids), b"", b""))
    table = pa.table({c: pa.array(v, pa.int32() if c == "part" else pa.binary()) for c, v in
                      zip(("part", "keys", "key_ids", "digests", "docs"), zip(*rows), strict=True)})
    found, most = peak(lambda: ngram_jaccard._found(table))
    first: dict[int, int] = {}
    want = []
    for k, i in zip(np.concatenate(keys).tolist(), np.concatenate(owners).tolist(), strict=True):
        if k in first:
            want.append((ngram_jaccard.MEMBER, np.uint64(k).astype(np.int64).item(), i, first[k]))
        first.setdefault(k, i)
    assert sorted(tuple(r.values()) for r in found.to_pylist()) == sorted(want) and len(want) >= 450
    assert most < 4 * sum(k.nbytes for k in keys)


def test_large_near_copies_are_compared_in_little_memory():
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    sets = [np.sort(np.delete(base, rng.integers(0, len(base), i))) for i in range(60)]
    sets.append(np.unique(rng.integers(0, 1 << 63, 500).astype(np.uint64)))
    ids = list(range(len(sets)))
    table = pa.table({"id": pa.array([*ids, 100, 101], pa.int64()), "comp": pa.array([*ids, 100, 101], pa.int64()),
                      "asks": [False] * len(sets) + [True] * 2,
                      "tokens": pa.array([s.tobytes() for s in [*sets, base, base[:100]]], pa.binary())})
    links, most = peak(lambda: ngram_jaccard._compare(ngram_jaccard.scheme(4, 5))(table))
    assert sorted(zip(*links.to_pydict().values(), strict=True)) == [(100, i) for i in range(60)]
    assert most < 6 * sum(s.nbytes for s in sets)


def test_large_batches_travel_as_small_ones(spark):
    rng = np.random.default_rng(5)
    docs = spark.createDataFrame([(i, " ".join(map(str, rng.integers(0, 10**6, 50)))) for i in range(40)],
                                 "doc_id long, text string").coalesce(1)
    sizes = []
    own = type(docs)
    whole = own.mapInArrow

    def spied(self, run, schema):
        def counted(batches):
            for b in run(batches):
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
        sizes.append(max(r.n for r in whole(self, counted, "n long").collect()))
        return whole(self, run, schema)

    own.mapInArrow = spied
    try:
        ngram_jaccard._keyed(docs, 5, (4, 5), 64)
    finally:
        own.mapInArrow = whole
    assert 0 < sizes[0] <= 8


def test_borders_are_asked_for_pieces_of_several_characters_only():
    own = piece_viterbi.PieceCoder(tokenizer("piece_bpe_32k.model"))
    asked, merged = [], own.merged
    own.holds, holds = lambda a, b: asked.append((a, b)) or holds(a, b), own.holds
    texts = ["the house of rising sun, thehouse qzxjkw", "où été ǅ 漢字 \U0001f600\U0001f600 a\tb\n\nc   d", "<s> <0x0A> ▁▁"]
    assert [np.frombuffer(x, "<i4").tolist() for x in own.encode_texts(texts)] == [own.model.encode(t) for t in texts]
    assert asked and all(len(b) > 1 for _, b in asked) and merged("a") == ["a"]


def test_noted_steps_and_borders_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_viterbi, "WORD_MEMORY", 20)
    own = piece_viterbi.PieceCoder(tokenizer("piece_bpe_32k.model"))
    rng = np.random.default_rng(6)
    texts = [" ".join("".join(rng.choice(list("etaoinshrdluüß漢"), 9)) for _ in range(40)) for _ in range(10)]
    for t in texts:
        assert np.frombuffer(own.encode_texts([t])[0], "<i4").tolist() == own.model.encode(t)
    assert sum(len(s[1]) for s in own.endings.values()) <= 40 and sum(map(len, own.border.values())) <= 80


def test_known_words_are_looked_up_without_python():
    from tokenizers import Tokenizer
    path = tokenizer("word_bpe_49k.json")
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in ("", ".", ",", "é")]
    long = "x1" * 60
    text = " ".join([*words, long, long]).encode()
    lib = Tokenizer.from_file(path)
    want = np.array([*lib.encode(text.decode(), add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert token_parquet.encode_texts([text, b"", text], path) == [want, b"\1\0\0\0", want]
    assert not any(len(w) > token_parquet.LONGEST_KEPT for w in token_parquet._WORDS[path])
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        again = token_parquet.encode_texts([" ".join(words).encode()] * 3, path)
    finally:
        sys.setprofile(None)
    assert len(calls) < len(words) and len(set(again)) == 1


def test_language_table_grows_with_the_grams():
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 123, 200_000).astype(np.uint8))
    grams = np.unique(kernel_langid.gram_codes(text)).astype(np.int32)[::3]
    kernel_langid._TABLES.clear()
    table, most = peak(lambda: kernel_langid._table(grams))
    codes = np.concatenate([kernel_langid.gram_codes(text), kernel_langid.gram_codes("Ünïcode, 12 ÿ".encode())])
    at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
    assert table[codes].tolist() == np.where(grams[at] == codes, at, len(grams)).tolist()
    assert most < 8 << 20
    none = kernel_langid._table(grams[:0])
    assert none[codes].tolist() == [0] * len(codes)


def test_language_verdicts_take_only_the_texts_to_python(spark):
    docs = spark.createDataFrame([(i, lang, text, "x" * 100) for i, (lang, text) in enumerate(
        [("en", "the house of the rising sun and the sea"), ("de", "das Haus am See und der alte Mann"), (None, None), (None, "12 !?")] * 3)],
        "doc_id long, lang string, text string, source string")
    kept = kernel_langid.claimed(docs, kernel_langid.fit(docs))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 4, 5, 8, 9]
