"""The operators against brute force, exact round trips and odd inputs."""

import contextlib
import hashlib
import os
import re
import threading
import time
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tillcast.llm import (
    best_fit,
    chat_tree,
    grid_join,
    kernel_langid,
    license_scan,
    ngram_jaccard,
    pii,
    piece_viterbi,
    pruned_graph,
    queries,
    token_parquet,
)
from tillcast.llm.common import components, setting
from tillcast.llm.vectors import dimension, matrix
from tillcast.session import checkpoint_dir

SF = "/root/testdata/sf0.001"
DOCS = "text string, doc_id long, tokens string, id int, key string, n int, part int, kind string, lang string"
ODD = [None, "", "   \n", "a", "A b", "x" * 50_000, "é 日本語 <|endoftext|> \U0001f600", "tie tie tie tie tie"]
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def frame(spark, texts, lang=None):
    """Documents whose further columns have the operators' own names."""
    return spark.createDataFrame([(t, i, "t", 1, "k", 2, 3, "q", lang[i] if lang else None)
                                  for i, t in enumerate(texts)], DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_set(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_components(sets, num, den):
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and den * c >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("k", "num", "den"), [(4, 85, 100), (5, 4, 5)])
def test_jaccard_components_equal_brute_force(spark, k, num, den):
    rng = np.random.default_rng(3)
    base = [[f"w{rng.integers(500)}" for _ in range(n)] for n in (6, 9, 14, 30, 45, 60, 90, 150, 240, 500)]
    texts = list(ODD)
    for words in base:
        for _ in range(12):
            own = list(words)
            for _ in range(rng.integers(0, max(2, len(own) // 40 + 2))):
                own[rng.integers(len(own))] = f"n{rng.integers(10_000)}"
            texts.append(" ".join(own))
    rows = ngram_jaccard.link_components(frame(spark, texts), k, num, den).collect()
    sets = [brute_set(t, k) for t in texts]
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in enumerate(sets)}
    assert [r.component_id for r in sorted(rows, key=lambda r: r.doc_id)] == brute_components(sets, num, den)


@pytest.mark.parametrize(("num", "den"), [(85, 100), (4, 5)])
def test_linked_sets_share_a_key(num, den):
    rng, own = np.random.default_rng(5), ngram_jaccard.scheme(num, den)
    for _ in range(400):
        n = int(np.exp(rng.uniform(np.log(4), np.log(600))))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[rng.integers(0, n // 6 + 1):], rng.integers(0, 1 << 63, rng.integers(0, n // 6 + 1))
                           .astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        if own.linked(len(np.intersect1d(a, b)), len(a), len(b)) and not np.array_equal(a, b):
            keys, sets = ngram_jaccard.lookup_keys(np.concatenate([a, b]), np.array([len(a), len(b)]), own)
            assert len(np.intersect1d(keys[sets == 0], keys[sets == 1]))


def test_packed_ids_round_trip():
    for ids in ([], [7], [-5, -5, 0, 3, 3, 1 << 40], [-(1 << 63), (1 << 63) - 1]):
        ids = np.array(ids, np.int64)
        assert ngram_jaccard._ids(ngram_jaccard._ascending(ids)).tolist() == ids.tolist()


def test_asked_documents_are_kept_whole(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in [-9, -1, 0, 1, 5, 5, 1 << 40, None]], "doc_id long, text string")
    for ids in ([], [-9, 0, 5, 77], [-1, 1, 1 << 40]):
        asked = spark.createDataFrame([(i,) for i in ids], "doc_id long")
        got = sorted(tuple(r) for r in ngram_jaccard._only(docs, asked, "doc_id").collect())
        assert got == sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in ids)


def test_jaccard_empty_null_ids_and_repeats(spark):
    assert ngram_jaccard.link_components(empty(spark), 4, 85, 100).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e"), (3, "a b c d e"), (3, "q r s t u"), (1, "q r s t u")],
                                 "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in ngram_jaccard.link_components(docs, 4, 85, 100).collect())
    assert got == [(-1, -1), (1, 1), (3, 1), (3, 1)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert {got[i] for i in range(21)} == {0} and {got[100 + i] for i in range(50)} == {100}


VECTORS = "embedding array<float>, vec_id long, v string, label int, ids string"


def vectors(spark, rows):
    return spark.createDataFrame([(v, i, "v", 0, "x") for i, v in rows], VECTORS)


def test_grid_join_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 24))
    x[100:180] = x[0] + 0.15 * rng.normal(size=(80, 24))
    x[200] = x[201]
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x.astype(np.float32))]
    odd = [(900, None), (901, [0.0] * 24), (902, [float("nan")] * 24), (903, [None] * 24), (904, [1.0])]
    got = {r.vec_id: r for r in grid_join.near_duplicates(vectors(spark, rows + odd)).collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    assert [got[i].n_links for i in range(300)] == links.sum(axis=1).tolist()
    sets = [set(np.flatnonzero(r)) | {i} for i, r in enumerate(links)]
    label = list(range(300))
    for _ in range(300):
        label = [min(label[j] for j in s) for s in sets]
    assert [got[i].component_id for i in range(300)] == label
    assert all(got[i].n_links == 0 and got[i].kept for i, _ in odd)
    assert grid_join.near_duplicates(vectors(spark, [])).count() == 0


def test_grid_join_takes_disk_in_proportion_to_its_vectors(spark, scratch, monkeypatch):
    rng = np.random.default_rng(21)
    x = rng.normal(size=(6000, 64))
    x[2000:2600] = x[rng.integers(0, 50, 600)] + 0.2 * rng.normal(size=(600, 64))
    x[2600:3000] = x[7] + 0.25 * rng.normal(size=(400, 64))
    x = x[rng.permutation(6000)].astype(np.float32)
    path = f"{scratch}/v"
    vectors(spark, [(i // 2 if i < 60 else i, v.tolist()) for i, v in enumerate(x)]).write.parquet(path)
    # Small blocks and intervals: as many of them as a large table has.
    for name, value in (("BLOCK", 64), ("LEAST_VECTORS", 1), ("LEAST_ROUND", 1)):
        monkeypatch.setattr(grid_join, name, value, raising=False)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    places = [checkpoint_dir(spark).removeprefix("file:"), *(d.getPath() for d in blocks)]

    def used():
        total = 0
        for place in places:
            for folder, _, names in os.walk(place):
                for name in names:
                    with contextlib.suppress(OSError):
                        total += os.path.getsize(f"{folder}/{name}")
        return total

    ended, sizes, start = threading.Event(), [], used()

    def watch():
        while not ended.wait(0.05):
            sizes.append(used() - start)

    watching = threading.Thread(target=watch)
    watching.start()
    try:
        with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):      # as with large tables
            got = grid_join.near_duplicates(spark.read.parquet(path)).collect()
    finally:
        ended.set()
        watching.join()
    assert max(sizes) < 8 * x.nbytes            # the blocks, shuffles of two rounds and small tables
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    ids = np.array([i // 2 if i < 60 else i for i in range(6000)])
    links = u @ u.T >= 0.9
    np.fill_diagonal(links, False)
    n = np.zeros(6000, int)
    np.add.at(n, ids, links.sum(axis=1))
    label = np.arange(6000)
    a, b = np.nonzero(links)
    while True:
        before = label.copy()
        np.minimum.at(label, ids[a], label[ids[b]])
        if (label == before).all():
            break
    assert sorted(tuple(r) for r in got) == sorted((i, n[i], label[i], label[i] == i) for i in ids.tolist())


def test_bound_of_a_product_is_not_below_it():
    rng = np.random.default_rng(22)
    for dim, spread in ((5, 1.0), (64, 1.0), (64, 1e-6), (300, 0.05)):
        x = rng.normal(size=dim) + spread * rng.normal(size=(200, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for head in {4, dim // 2, dim}:
            heads = grid_join._heads(x, head)
            assert (heads @ heads.T + grid_join._rounding(head) >= x @ x.T).all()


def test_usable_vectors_of_a_column():
    values = [None, [], [1.0, 2.0], [1.0, None], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [3.0], [0.0, -4.0]]
    for column in (pa.array(values), pa.array(values, pa.list_(pa.float32())), pa.array([[9.0, 9.0], *values]).slice(1)):
        rows, x = matrix(column, 2)
        assert rows.tolist() == [2, 8] and x.tolist() == [[1.0, 2.0], [0.0, -4.0]] and x.dtype == np.float64
        assert matrix(column, 4)[1].shape == (0, 4)
    assert matrix(pa.array([], pa.list_(pa.float64())), 2)[1].shape == (0, 2)


def test_pruned_graph_recall_and_ties(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[50:120] = x[50]
    rows = vectors(spark, [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(9000, None), (9020, [0.0] * 16)])
    index, dim = pruned_graph.build_index(rows, shard_vectors=300)
    got = pruned_graph.search(index, dim, rows.filter("vec_id % 20 = 0"), k=20).collect()
    scores = x.astype(float) @ x.astype(float).T
    np.fill_diagonal(scores, -np.inf)
    hits = total = 0
    for q in range(0, 700, 20):
        want = np.lexsort((np.arange(700), -scores[q]))[:20]
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 21)) and q not in {r.vec_id for r in own}
        assert np.allclose([r.score for r in own], [scores[q, r.vec_id] for r in own])
        hits, total = hits + len({r.vec_id for r in own} & set(want.tolist())), total + 20
    assert hits / total >= 0.9 and not {9000, 9020} & {r.query_id for r in got}
    index, dim = pruned_graph.build_index(vectors(spark, []))
    assert pruned_graph.search(index, dim, vectors(spark, [])).count() == 0


def brute_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    found = [(i, label) for phrase, label in license_scan.BASE_PHRASES.items() for i in range(len(words))
             if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return (len(words), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found})))


def test_licence_scan_base_equals_brute_force(spark):
    texts = [*ODD, "CC-BY cc by; All rights\nreserved. general  PUBLIC license", "cc byte all rights reserveds",
             "SPDX-License-Identifier: (MIT OR GPL-2.0) AND Apache-2.0 */", "écc by cc by by cc cc by"]
    rows = sorted(license_scan.scan(frame(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows] == list(map(brute_scan, texts))
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | set() and 0 <= r.score <= 1
               for r in rows)
    assert rows[len(ODD) + 2].labels == "apache-2.0,gpl-2.0,mit"
    assert license_scan.scan(empty(spark)).count() == 0


def test_licence_expressions():
    value = lambda e: license_scan.evaluate(license_scan.parse_expression(e))[0]
    assert value("MIT OR GPL-3.0") == 1.0 and value("MIT AND GPL-3.0") == 0.5
    assert value("GPL-2.0 WITH Classpath-exception-2.0 OR proprietary") == pytest.approx(0.6)
    assert value("proprietary AND (MIT OR GPL-3.0) -->") == license_scan.UNKNOWN_FREEDOM
    assert license_scan.parse_expression("MIT AND") == ["mit"] and license_scan.parse_expression("(MIT") is None


@needs_data
def test_language_accuracy_and_odd_texts(spark):
    got = queries.QUERIES["op4_kernel_langid"](spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    texts = ["the house of the rising sun", "le chat de la maison"] * 4 + [None, "", "12 34 ?!"]
    docs = frame(spark, texts, lang=["en", "fr"] * 4 + [None] * 3)
    out = {r.doc_id: r for r in kernel_langid.predict(docs, kernel_langid.fit(docs)).collect()}
    assert [out[i].lang_pred for i in range(8)] == ["en", "fr"] * 4
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (8, 9, 10))
    nothing = kernel_langid.fit(empty(spark))
    assert {r.lang_pred for r in kernel_langid.predict(docs, nothing).collect()} == {"und"}


def tokenizer(name):
    path = queries.tokenizer(name)
    if not os.path.exists(path):
        pytest.skip("tokenizer files not present")
    return path


def sample_texts(spark):
    own = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] if os.path.exists(SF) else []
    return [*ODD, "don't İstanbul ǅ ﬁ <s> <0x0A>", "a b​c\x1cd 　e 12,34.5 ...,", " " * 9, *own]


def test_pieces_equal_the_library_and_decode(spark):
    path = tokenizer("piece_bpe_32k.model")
    own, texts = piece_viterbi.coder(path), sample_texts(spark)
    assert [np.frombuffer(x, "<i4").tolist() for x in own.encode_texts([t or "" for t in texts])] == \
        [own.model.encode(t or "") for t in texts]
    rows = piece_viterbi.encode(frame(spark, texts), path)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in rows.collect())
    back = {r.doc_id: r.text for r in piece_viterbi.decode(rows, path).collect()}
    assert [back[i] for i in range(len(texts))] == [t or "" for t in texts]
    assert piece_viterbi.encode(empty(spark), path).count() == 0


def test_token_files_round_trip(spark, scratch):
    from tokenizers import Tokenizer
    path = tokenizer("word_bpe_49k.json")
    texts, lib = sample_texts(spark), Tokenizer.from_file(path)
    folder = os.path.join(scratch, "tokens")
    token_parquet.write_tokens(frame(spark, texts).repartition(3), folder, path)
    want, start = [], 0
    for i, t in enumerate(texts):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = token_parquet.token_digests(spark, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
    part = token_parquet.read_tokens(spark, folder, 2, 4).collect()
    assert sorted((r.doc_id, r.start, len(r.ids)) for r in part) == [w[:3] for w in want[2:5]]
    files = [os.path.join(d, f) for d, _, fs in os.walk(f"{folder}/tokens") for f in fs if f.endswith(".parquet")]
    columns = pq.ParquetFile(files[0]).metadata.row_group(0)
    by_name = {columns.column(i).path_in_schema: columns.column(i) for i in range(columns.num_columns)}
    assert "DELTA_BINARY_PACKED" in by_name["n_tokens"].encodings and by_name["n_tokens"].has_offset_index
    folder = os.path.join(scratch, "none")
    token_parquet.write_tokens(empty(spark), folder, path)
    assert token_parquet.token_digests(spark, folder).count() == 0


def brute_spans(text):
    def luhn(d):
        d = [int(c) for c in d][::-1]
        return (sum(d[::2]) + sum(2 * a - 9 * (a > 4) for a in d[1::2])) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15)]
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules)
                  for m in re.finditer(p, text or "") if ok(m.group()))


def test_personal_data_base_equals_brute_force(spark):
    texts = [*ODD, "a@b.c_d@e.f x", "é 1.2.3.4 999.1.1.1 0001.2.3.255 4111 1111 1111 1111x +1 (988) 555-2485",
             "4111-1111-1111-1111, 4111-1111-1111-1112 call +1 (988) 555-2485.", "1.1.1.1.1.1.1.1",
             "a@" + "b." * 9000 + "c", "+" + "1 " * 3000, 'password=45bb0d53635bf1b89d token = "3f76bb46f51625a0"']
    rows = {r.doc_id: r for r in pii.detect(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        spans, r = brute_spans(t), rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in spans) for j in range(4)]
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) or not listed
    masked = {r.doc_id: r for r in pii.mask_documents(frame(spark, texts)).collect()}
    assert "4111" not in masked[len(ODD) + 2].text.replace("4111-1111-1111-1112", "")
    assert [masked[i].text for i in range(len(ODD))] == ODD and masked[0].kind == "q"
    assert pii.detect(empty(spark)).count() == 0 and pii.mask_documents(empty(spark)).columns == empty(spark).columns


def test_personal_data_with_very_many_matches(spark):
    """Positions over many blocks, and masks with overlaps (a card number in an address)."""
    texts = ["é😀 a.4111111111111111@b.example.com 1.2.3.4 " * 12_500, "z" * 5000 + " a@b.de " + "😀" * 3000,
             "a@b.de" * 127, "x 1.2.3.4 " * 128, "x 1.2.3.4 " * 129]
    rows = {r.doc_id: r for r in pii.detect(frame(spark, texts)).collect()}
    masked = {r.doc_id: r.text for r in pii.mask_documents(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        spans, at, out = brute_spans(t), 0, []
        listed = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert rows[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and rows[i].spans == listed
        assert rows[i].n_spans == len(spans) and rows[i].has_personal_data == bool(spans)
        for a, k, b in spans:
            if a >= at:
                out.append(t[at:a] + f"[{pii.KINDS[k].upper()}]")
            at = max(at, b)
        assert masked[i] == "".join(out) + t[at:]


def test_packing_keeps_everything_within_capacity(spark):
    texts = [*ODD, *("w " * n for n in range(1, 400, 7)), "w " * 20_000]
    rows = best_fit.best_fit(frame(spark, texts), shard_pieces=25).collect()
    tokens = {i: len((t or "").split()) + 1 for i, t in enumerate(texts)}
    for i, n in tokens.items():
        own = sorted((r.start, r.length) for r in rows if r.doc_id == i)
        assert [s for s, _ in own] == [sum(x for _, x in own[:k]) for k in range(len(own))]
        assert sum(x for _, x in own) == n
    for b in {r.bin_id for r in rows}:
        own = sorted((r.offset, r.length, r.capacity, r.used) for r in rows if r.bin_id == b)
        used = sum(x[1] for x in own)
        assert [x[0] for x in own] == [sum(y[1] for y in own[:k]) for k in range(len(own))]
        assert {x[3] for x in own} == {used} and {x[2] for x in own} == {min(c for c in best_fit.LENGTHS if c >= used)}
    assert best_fit.best_fit(empty(spark)).count() == 0


def test_packing_is_near_the_best_cost():
    # Every way to split six pieces into bins, against the packer.
    sizes, lengths = [500, 400, 300, 260, 120, 90], (512, 1024)

    def best(rest, bins):
        if not rest:
            return sum(best_fit.cost(min(c for c in lengths if c >= b)) for b in bins)
        head, tail = rest[0], rest[1:]
        options = [best(tail, [*bins[:i], b + head, *bins[i + 1:]]) for i, b in enumerate(bins) if b + head <= 1024]
        return min([*options, best(tail, [*bins, head])])

    got = sum(best_fit.cost(c) for c, _ in best_fit.pack(sizes, lengths))
    assert best(sizes, []) <= got <= 1.25 * best(sizes, [])


def test_chat_trees_round_trip_and_share(spark, scratch):
    bad = "\\### Assistant: </turn> ok\\"
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate(
        [("user", bad), ("assistant", f"a{c % 3}</turn>\n### user: x"), ("us:er", None), (None, f"{c % 5}#")])]
    rows += [(77, 0, "assistant", ""), (None, 1, "user", "x"), (78, None, "assistant", "first"), (78, 0, "assistant", "second")]
    turns = spark.createDataFrame([(x, r, t, c, "p") for c, t, r, x in rows],
                                  "text string, role string, turn long, conv_id long, path string")
    chat_tree.write_chat(turns, f"{scratch}/chat")
    got = {r.conv_id: r for r in chat_tree.read_digests(spark, f"{scratch}/chat").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        said = "".join(x or "" for _, _, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(said) and got[c].loss_sha256 == sha(said)
        assert got[c].turns_sha256 == sha("".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in own))
    stored = spark.read.parquet(f"{scratch}/chat").collect()
    assert sum(len(s.text) for s in stored) < 0.5 * sum(r.formatted_chars for r in got.values())
    for s in stored:
        for n, parent in enumerate(s.node_parent):
            if parent >= 0:
                seen = sum(b - a for a, b in zip(s.node_attends[n][::2], s.node_attends[n][1::2], strict=True))
                assert seen == s.node_position[n]       # a turn sees its ancestors, all of them and no more
    chat_tree.write_chat(turns.limit(0), f"{scratch}/none")
    assert chat_tree.read_digests(spark, f"{scratch}/none").count() == 0


@needs_data
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_that_stay_are_not_shuffled(spark):
    rows = spark.range(2000).selectExpr("id AS doc_id", "repeat('x', 50) AS text")
    dropped = rows.filter("doc_id % 7 = 0").select("doc_id")
    kept = ngram_jaccard.without(rows, dropped, "doc_id")
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(2000) if i % 7]
    assert ngram_jaccard._near_only(rows, dropped, "doc_id").count() >= dropped.count()
    assert not re.search(r"Exchange hashpartitioning\(doc_id", plan_of(ngram_jaccard._near_only(rows, dropped, "doc_id")))


def test_equal_sets_of_several_batches_are_one_node(spark):
    pairs = spark.createDataFrame([(2, 1, 3), (3, 1, 1), (3, 2, 2), (9, 3, 1)], "x long, y long, votes long")
    same = spark.createDataFrame([(2, 1)], "id long, of long")
    got = sorted(tuple(r) for r in ngram_jaccard._merged(pairs, same).collect())
    assert got == [(3, 1, 3), (9, 3, 1)]
    places = spark.createDataFrame([(1, 5), (3, 6)], "id long, comp long")
    assert sorted(tuple(r) for r in ngram_jaccard._with_same(places, same).collect()) == [(1, 5), (2, 5), (3, 6)]


def test_rows_of_one_id_with_several_sets_keep_all_links(spark):
    long = [" ".join(f"w{i}{j}" for j in range(80)) for i in range(3)]
    rows = [(1, long[0]), (2, long[0]), (2, long[1]), (3, long[1] + " more"), (4, long[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in ngram_jaccard.link_components(docs, 5, 4, 5).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_only_members_that_a_query_may_link_with_go_on():
    one, other = np.zeros(ngram_jaccard.BITS, bool), np.zeros(ngram_jaccard.BITS, bool)
    one[:100], other[2000:2100] = True, True
    pack = lambda b: np.packbits(b).tobytes()
    rows = pa.table({"asked": [0] * 3, "fan": [0] * 3, "id": [1, 2, 3], "comp": [1, 2, 3], "asks": [True, False, False],
                     "n": [100] * 3, "bits": [pack(one), pack(one), pack(other)]})
    got = ngram_jaccard._near(ngram_jaccard.scheme(4, 5))(rows).to_pylist()
    assert [(r["id"], r["asks"]) for r in got] == [(1, True), (2, False)]


def test_filter_on_masked_text_has_a_short_plan(spark):
    docs = spark.createDataFrame([(1, "mail to ann@site.example now"), (2, None)], "doc_id long, text string")
    clean = pii.mask_documents(docs)
    assert clean.filter("text RLIKE '[a-z]@'").count() == 0
    assert clean.filter("text RLIKE 'EMAIL'").count() == 1
    assert pii.mask_documents(docs.select("text")).count() == 2


def test_small_sums_of_expectation_maximisation(spark):
    counted = spark.createDataFrame([(0, 1, 1, 0, 1, 5), (2, -1, 0, 0, -1, 3)],
                                    "kind int, form int, gazetteer int, context int, border int, n long")
    prior, votes = pii.reliabilities(counted, 3)
    assert prior[0] > prior[2] and abs(prior[1] - pii.PRIOR) < 1e-9
    assert votes["form"][1][0] > votes["form"][1][1]


def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    more = spark.createDataFrame([(10**6, "12 !?", "en", "s", 5), (10**6 + 1, None, None, None, None)], docs.schema)
    docs = docs.unionByName(more)
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == columns and kept.count() == docs.count() - 2
    once = corpus_pipeline.near_duplicates(spark, kept, SF)
    rows = kept.select("doc_id", "text").collect()
    sets = [brute_set(r.text, 5) for r in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i].doc_id)
    label = brute_components([sets[i] for i in order], 4, 5)
    assert sorted(r.doc_id for r in once.collect()) == [rows[order[i]].doc_id for i in range(len(order)) if label[i] == i]
    clean = corpus_pipeline.personal_data(spark, once, SF)
    assert clean.columns == columns and not clean.filter("text RLIKE '[a-z0-9]@[a-z]+[.]example'").count()
    packed = corpus_pipeline.packing(spark, clean, SF).collect()
    assert {d for r in packed for d in r.doc_ids} == {r.doc_id for r in clean.collect()}


WORDS = {
    "en": "the house of rising sun and where they have been with which every child would then speak about those things",
    "de": "der garten und die schönen blumen sind nicht mehr zwischen den häusern gewachsen welche keiner je gesehen hat",
    "fr": "le chat de la maison est dans notre jardin avec les enfants qui mangent du pain sous cette grande fenêtre",
    "es": "los niños que comen pan con mucha leche estaban cerca del camino donde ayer llovía sobre aquellos árboles",
    "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan heille on annettu järki sekä omatunto myös ystävyyden",
}


def sentences(lang, n):
    rng = np.random.default_rng(len(lang) + sum(map(ord, lang)))
    return [" ".join(rng.choice(WORDS[lang].split(), 40)) for _ in range(n)]


@pytest.mark.parametrize("learned", [["en"], ["en", "fr"], ["en", "de", "fr", "es"]])
def test_pipeline_rejects_texts_of_no_learned_language(spark, learned):
    import corpus_pipeline
    rows = [(t, x) for x in learned for t in sentences(x, 30)]
    clean = len(rows)
    rows += [(t, None) for t in sentences("fi", 10)]
    rows += [("Все люди рождаются свободными и равными в своем достоинстве и правах", None),
             ("すべての人間は生まれながらにして自由でありかつ尊厳と権利とについて平等である", None),
             ("xqz wvkj qpzx jjkw zzxq vbnq kxwz qwjx pzvk xjqq wkzv bqxj", None)]
    docs = frame(spark, [t for t, _ in rows], lang=[x for _, x in rows])
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(clean))


@needs_data
def test_pipeline_language_border_on_the_documents(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    unlearned = docs.lang == "es"
    kept = corpus_pipeline.language_id(spark, docs.withColumn("lang", F.when(~unlearned, docs.lang)), SF)
    ids = {r.doc_id for r in kept.collect()}
    own = docs.select("doc_id", unlearned.alias("es")).collect()
    assert all(r.doc_id in ids for r in own if not r.es)
    assert sum(r.doc_id in ids for r in own if r.es) <= 0.2 * sum(r.es for r in own)


def test_pipeline_judges_rows_with_null_and_repeated_ids(spark):
    import corpus_pipeline
    en = sentences("en", 12)
    rows = [(en[0], 1), (en[1], 1), (en[2], 1),                     # one id, three texts
            (en[3], None), (en[4], None), (en[3], None),            # no id; one text twice
            (en[5], 7), (en[5], 7), (en[5], 9), (en[5], None),      # a copy of every kind: the smallest id stays
            (en[6], 8), ("Все люди рождаются свободными", 8), (None, 8), ("12 !?", None)]
    rows += [(t, 100 + i) for i, t in enumerate(en[7:])]
    docs = spark.createDataFrame([(t, i, "t", 1, "k", 2, 3, "q", "en" if t in en else None) for t, i in rows], DOCS)
    told = corpus_pipeline.language_id(spark, docs, SF)
    key = lambda r: (r[0], r[1] is None, r[1] or 0)
    assert sorted(((r.text, r.doc_id) for r in told.collect()), key=key) == sorted((r for r in rows if r[0] in en), key=key)
    once = corpus_pipeline.near_duplicates(spark, told, SF)
    assert once.columns == docs.columns
    want = [(en[0], 1), (en[1], 1), (en[2], 1), (en[3], None), (en[4], None), (en[5], 7), (en[6], 8), *rows[14:]]
    assert sorted(((r.text, r.doc_id) for r in once.collect()), key=key) == sorted(want, key=key)
    clean = corpus_pipeline.personal_data(spark, once, SF)
    packed = corpus_pipeline.packing(spark, clean, SF).collect()
    assert sorted((p.doc_id is None, p.doc_id or 0) for r in packed for p in r.pieces) == \
        sorted((i is None, i or 0) for _, i in want)


@pytest.mark.parametrize("second", [1, 2])
def test_pipeline_keeps_columns_named_like_its_own(spark, second):
    """With distinct ids and with a repeated one, clashing columns come back as they went in."""
    import corpus_pipeline
    words = [" ".join(f"{stem}{i}" for i in range(30)) for stem in ("a", "b", "a")]
    rows = [(1, words[0], 70, "x"), (second, words[1], 80, "y"), (3, words[2], 90, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pipeline_row long, doc string")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted(tuple(r) for r in out.collect()) == rows[:2]


def test_language_sample_is_bounded_when_an_id_repeats(spark):
    docs = spark.createDataFrame([(t, 5, "t", 1, "k", 2, 3, "q", "en") for t in sentences("en", 40)] +
                                 [(t, 6, "t", 1, "k", 2, 3, "q", "fr") for t in sentences("fr", 3)], DOCS)
    assert kernel_langid.fit_rows(docs, F.lit(True), 10).count() == 2


@pytest.mark.parametrize("same", [None, 5])
def test_packing_deals_equal_rows_to_many_shards(spark, same):
    docs = spark.createDataFrame([("w " * 30, same, "t", 1, "k", 2, 3, "q", None)] * 400 +
                                 [("w " * 30, 1000 + i, "t", 1, "k", 2, 3, "q", None) for i in range(400)], DOCS)
    rows = best_fit.best_fit(docs, shard_pieces=100).collect()
    assert len(rows) == 800 and sum(r.doc_id == same for r in rows) == 400
    shards = [r.bin_id.split("-")[0] for r in rows]
    assert max(map(shards.count, set(shards))) <= 200


def test_packing_keeps_large_ids_beside_a_null(spark):
    ids = [9_007_199_254_740_993, None, 9_007_199_254_740_995, -9_007_199_254_740_993]
    rows = spark.createDataFrame([(i, "a b c") for i in ids], "doc_id long, text string")
    got = [r.doc_id for r in best_fit.best_fit(rows).collect()]
    assert sorted(got, key=str) == sorted(ids, key=str)


def test_dimension_counts_usable_vectors_only(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0])] + [(i, v) for i, v in enumerate(
        [[], [], [], [0.0] * 3, [0.0] * 3, [0.0] * 3, [None, 1.0, 2.0], [float("nan"), 1.0, 2.0],
         [float("inf"), 1.0, 2.0], None], start=3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert dimension(df) == 2
    links = {r.vec_id: (r.n_links, r.component_id) for r in grid_join.near_duplicates(df, cosine=0.9).collect()}
    assert links[1] == (1, 1) and links[2] == (1, 1) and links[3] == (0, 3)
    index, dim = pruned_graph.build_index(df)
    found = pruned_graph.search(index, dim, df).collect()
    assert {(r.query_id, r.vec_id) for r in found} == {(1, 2), (2, 1)}


def test_search_gives_whole_blocks_ties_and_repeated_ids(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 8)).round(2)
    x[150:200] = x[0]                                  # copies
    x[200:230, :4], x[200:230, 4:] = 1.0, np.eye(4)[rng.integers(0, 4, 30)]      # ties between different vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist()), (7, x[9].tolist()), (None, x[3].tolist()),
                                                         (400, [1.0]), (401, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(pruned_graph, "QUERY_BLOCK", 64)
    index, dim = pruned_graph.build_index(df, shard_vectors=120)
    queries_ = df.filter("vec_id % 20 = 0")
    found = pruned_graph.search(index, dim, queries_, k=20, beam=300).collect()
    assert {r.query_id for r in found} == set(range(0, 300, 20))
    plain = [(i, np.array(v)) for i, v in rows if i is not None and v is not None and len(v) == 8]
    hits = 0
    for own in range(0, 300, 20):
        best = sorted((round(-float((v * x[own]).sum()), 9), i) for i, v in plain if i != own)
        got = [(round(-r.score, 9), r.vec_id) for r in sorted(found, key=lambda r: r.rank) if r.query_id == own]
        # Exact scores, ties to the smaller id, no row twice but for ids that are repeated.
        assert len(got) == 20 and got == sorted(got) and set(got) <= set(best)
        hits += sum(s <= best[19][0] for s, _ in got)
        # Copies are one node: where one is found all are, by id.
        copies = [i for s, i in got if s == round(-float((x[0] * x[own]).sum()), 9)]
        assert copies == [i for i in [0, *range(150, 200)] if i != own][:len(copies)]
    assert hits >= 0.9 * 15 * 20


def test_licence_scan_is_linear_in_its_notices():
    """A hundred thousand notices in one text, of phrases that overlap, at their places."""
    base = {"cc by": "cc-by", "by cc": "turned", "all rights reserved": "reserved", "reserved": "short"}
    own = license_scan.LicenceScanner(base, {})
    n = 50_000
    start = time.monotonic()
    got = own.scan(b"start " + b"cc by " * n + b"all rights reserved " * n)
    assert time.monotonic() - start < 20
    words = 1 + 2 * n + 3 * n
    assert got[:4] == (words, n + (n - 1) + 2 * n, 1, words - 1)
    assert got[4] == "cc-by,reserved,short,turned"
    small = own.scan(b"all rights reserved by cc by x cc by")
    assert small[:4] == (9, 1 + 1 + 1 + 2, 0, 7)
