"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles; two link when the Jaccard similarity of their sets
reaches a threshold. The join finds every link:

1. *Lookup keys.* A set's hashes are cut into ``m`` ranges; two linked sets differ in at
   most ``H`` tokens (``Scheme``). Large sets: with ``m`` > ``H`` some range is equal in
   both, and a key is the hash of one range's tokens. Middle-sized sets have too few
   tokens for that: with ``m`` > ``H / 2`` some range differs by one token at most, and
   keys are the hashes of a range with and without each of its tokens. A few more ranges
   are cut and each set uses only its fullest, so that a line or passage that many
   documents share seldom makes a key by itself. Small sets are keyed by quadruples of their
   smallest hashes (prefixes for an overlap of four). Linked sets thus share a key.
2. *Groups.* Members of a key are compared with one of them; verified links give groups
   of similar documents; unlinked ones are grouped with the partner they share most keys
   with. Groups are cut at about ``GROUP_SIZE``. Most documents share no key with any
   other and are done.
3. *Token-group matrix.* Groups that share a key and are not of one component ask one
   another, the smaller the larger: the group's token union is formed, with the members
   that hold each token. A query document can only link into a group whose union holds
   enough of its tokens; groups below that bound stay closed to it. Sizes and a bitmap of
   the union give the bound first, so that sets move only for queries it leaves open.
4. *Opening.* In a group that qualifies, bitmaps bound the query's overlap with each member of
   another component; if some may link, its exact overlap with them is counted along the
   matrix's rows. Members that no query may link with take no part, so their sets stay.

Keys travel as packed arrays, one row per batch of documents and shuffle part, and a
batch sends a key once, so a key or text that a third of all documents share costs each
batch one entry. Equal sets of a batch are one node; those of several batches become one
before any set moves.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import batched, combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import SLICE_BYTES, components, release, setting, text_slices, utf8
from tillcast.llm.shingles import mix, shingle_sets
from tillcast.session import materialize

# Members of a group, and queries of a group that one task compares at once.
GROUP_SIZE, QUERIES_AT_ONCE = 256, 1024
# Sets up to SHORT tokens are keyed by PICK of them, up to MIDDLE by ranges less a token.
SHORT, PICK, MIDDLE = 40, 4, 128
MIN_PARTS = 64
# Size of the bitmap by which pairs are first compared.
BITS = 4096
# Tokens whose keys are made at once.
TOKENS_AT_ONCE = 1 << 17
# Rows of a batch that travel as one Arrow batch, and sub-ranges of a part's keys sorted one at a time.
ROWS_AT_ONCE, KEY_RANGE_BITS = 8, 3
# Tokens of members that a query's tokens are looked up in at once.
PLACES_AT_ONCE = 1 << 18
# Bytes of a group's rows from which on a worker gives back the memory that the group took.
LARGE_GROUP = 2 << 20
# Slots of the broadcast bitmap of rows asked for, by which others are kept from a shuffle: 4 MB at any input.
ID_SLOTS = 1 << 25
_WIDE = np.uint64(32)


class Scheme:
    """How sets are cut into ranges, by size class. Sizes of class c end at ``last[c]``;
    a linked set of at most ``last[c]`` tokens has its partner in class c + 1 at most. A
    set is keyed under its own class and the one below, so linked sets meet."""

    def __init__(self, num: int, den: int):
        if num * 100 < den * 76:
            raise ValueError("the similarity must be at least 0.76")
        self.num, self.den = num, den
        self.last = [1]
        while self.last[-1] < 1 << 40:
            self.last.append(max(self.last[-1] + 1, self.last[-1] * den // num))
        self.ends = np.array(self.last, dtype=np.int64)

    def cut(self, c: int) -> tuple[int, int, bool]:
        """Class c's ``(ranges, ranges that may differ too much, whether one token may differ)``."""
        s = self.last[c]
        h = (self.den - self.num) * (s + s * self.den // self.num) // (self.den + self.num)
        if s <= MIDDLE * self.den // self.num:
            return h // 2 + 2, h // 2, True
        return h + 1 + h // 4, h, False

    def linked(self, common: int, a: int, b: int) -> bool:
        return self.den * common >= self.num * (a + b - common) and common > 0


@lru_cache(maxsize=8)
def scheme(num: int, den: int) -> Scheme:
    return Scheme(num, den)


def lookup_keys(values: np.ndarray, counts: np.ndarray, own: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a batch of sets (as ``shingle_sets`` gives them): ``(keys, set numbers)``."""
    keys, sets = [], []
    owner = np.repeat(np.arange(len(counts)), counts)
    klass = np.searchsorted(own.ends, counts)
    long = counts > SHORT
    token = mix(values ^ np.uint64(0x5851F42D4C957F2D))
    at = np.flatnonzero(long[owner])
    for below in (0, 1) if len(at) else ():
        c = np.maximum(klass - below, 0)
        cuts = np.zeros((len(own.ends), 3), np.int64)
        for x in sorted(set(c[long].tolist())):
            cuts[x] = own.cut(x)
        m, bad, less = cuts[c].T
        o = owner[at]
        block = ((values[at] >> _WIDE) * m[o].astype(np.uint64)) >> _WIDE
        new = np.ones(len(at), bool)
        new[1:] = (o[1:] != o[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        s = o[first]
        name = mix((c[s].astype(np.uint64) << _WIDE) + block[first])
        total = np.add.reduceat(token[at], first) + name
        # Each set uses its largest ranges: those of at least the size of the (bad + 1)-th.
        # Of these one is equal (or one token away) in a linked set; whichever of the two
        # sets asks for the larger size, the other uses that range too.
        ranges = np.bincount(s, minlength=len(counts))
        order = np.lexsort((-size, s))
        nth = np.minimum(np.cumsum(ranges) - ranges + bad, max(len(s) - 1, 0))
        least = np.where(ranges > bad, size[order][nth], 0)
        scarce = long & (least <= less)
        least[scarce] = 0
        take = size >= least[s] - less[s]
        keys.append(mix(total[take]))
        sets.append(s[take])
        run = np.repeat(np.arange(len(first)), size)
        drop = (less[o] == 1) & (size >= least[s])[run]
        keys.append(mix(total[run[drop]] - token[at][drop]))
        sets.append(o[drop])
        # A set with too few filled ranges is keyed by its empty ones too.
        for i in np.flatnonzero(scarce):
            empty = np.setdiff1d(np.arange(m[i], dtype=np.uint64), block[o == i])
            keys.append(mix(mix((c[i].astype(np.uint64) << _WIDE) + empty)))
            sets.append(np.full(len(empty), i))
    # The smallest set above SHORT may link with the largest below.
    short = np.flatnonzero((counts >= PICK) & (counts * own.num <= SHORT * own.den))
    begin = np.concatenate([[0], np.cumsum(counts)])
    for i in short.tolist():
        n = int(counts[i])
        prefix = n - -(-own.num * n // own.den) + PICK
        head = mix(token[begin[i]:begin[i] + min(n, prefix)])
        key = mix(head[_picks(len(head))].sum(axis=1, dtype=np.uint64))
        keys.append(key)
        sets.append(np.full(len(key), i))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(sets)


@lru_cache(maxsize=64)
def _picks(n: int) -> np.ndarray:
    return np.array(list(combinations(range(n), PICK)), dtype=np.int64).reshape(-1, PICK)


# -- packed rows ------------------------------------------------------------------------

PACKED_SCHEMA = "part int, keys binary, key_ids binary, digests binary, docs binary"
FOUND_SCHEMA = "kind int, a long, b long, c long"
DOC, COPY, MEMBER = 0, 1, 2


def _ascending(ids: np.ndarray) -> bytes:
    """Ascending ids as differences, all lowest bytes first: nearly all zeros, which compress."""
    step = ids.view(np.uint64).copy()
    step[1:] -= ids.view(np.uint64)[:-1]
    return np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes()


def _ids(raw: bytes) -> np.ndarray:
    step = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64)
    return np.cumsum(step.ravel(), dtype=np.uint64).view(np.int64)


def _pack(ids: np.ndarray, texts: list[bytes], k: int, own: Scheme, parts: int):
    """One batch: its documents, the digests of its distinct sets, and their keys."""
    values, counts = shingle_sets(texts, k)
    # Digest of a set: two independent sums over its tokens, and its size.
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    digest = np.zeros((len(counts), 2), np.uint64)
    some = counts > 0
    if some.any():
        for j, salt in enumerate((0x1D8E4E27C47D124F, 0x5851F42D4C957F2D)):
            digest[some, j] = np.add.reduceat(mix(values ^ np.uint64(salt)), begin[some])
    # Equal sets of the batch: the smallest id stands for all.
    order = np.lexsort((ids, counts, digest[:, 1], digest[:, 0]))
    same = np.zeros(len(order), bool)
    a, b = order[1:], order[:-1]
    same[1:] = (digest[a] == digest[b]).all(axis=1) & (counts[a] == counts[b])
    stands = np.empty(len(order), np.int64)
    stands[order] = ids[order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]]
    rep = np.zeros(len(order), bool)
    rep[order[~same]] = True
    rep &= some
    rep_at = np.flatnonzero(rep)
    keys, key_ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    # A bounded number of tokens at a time: keys are a fraction of them, their making is not.
    for some in np.split(rep_at, np.flatnonzero(np.diff(np.cumsum(counts[rep_at]) // TOKENS_AT_ONCE)) + 1):
        if len(some):
            span = slice(begin[some[0]], begin[some[-1]] + counts[some[-1]])
            here = np.repeat(rep[some[0]:some[-1] + 1], counts[some[0]:some[-1] + 1])
            key, sets = lookup_keys(values[span][here], counts[some], own)
            keys.append(key)
            key_ids.append(ids[some[sets]])
    keys, key_ids = np.concatenate(keys), np.concatenate(key_ids)
    # A key once per batch; the others of the batch are its members by way of the first.
    order = np.lexsort((key_ids, keys))
    keys, key_ids = keys[order], key_ids[order]
    again = np.zeros(len(keys), bool)
    again[1:] = keys[1:] == keys[:-1]
    head = key_ids[np.maximum.accumulate(np.where(again, 0, np.arange(len(keys))))] if len(keys) else key_ids
    local = np.stack([np.full(int(again.sum()), MEMBER), keys[again].view(np.int64), key_ids[again], head[again]], 1)
    sent_keys, sent_ids = keys[~again], key_ids[~again]
    order = np.argsort(sent_ids, kind="stable")
    sent_keys, sent_ids = sent_keys[order], sent_ids[order]
    docs = np.concatenate([np.stack([np.full(len(ids), DOC), ids, counts, stands], 1), local])
    digests = np.stack([digest[rep_at, 0].view(np.int64), digest[rep_at, 1].view(np.int64), counts[rep_at],
                        ids[rep_at]], 1) if len(rep_at) else np.zeros((0, 4), np.int64)
    columns = [(sent_keys, (sent_keys % np.uint64(parts)).astype(np.int64)), (sent_ids, None),
               (digests, (digests[:, 0].view(np.uint64) % np.uint64(parts)).astype(np.int64)),
               (docs, (mix(docs[:, 2].view(np.uint64) + docs[:, 1].view(np.uint64)) % np.uint64(parts)).astype(np.int64))]
    # One stable sort by part a column; ids stay ascending within a part.
    cut = []
    for values, where in columns:
        if where is not None:
            order = np.argsort(where, kind="stable")
            ends = np.searchsorted(where[order], np.arange(parts + 1))
        cut.append((values[order], ends))
    (sent_keys, k_at), (sent_ids, _), (digests, g_at), (docs, d_at) = cut
    for part in range(parts):
        (k0, k1), (g0, g1), (d0, d1) = (e[part:part + 2] for e in (k_at, g_at, d_at))
        if k1 > k0 or g1 > g0 or d1 > d0:
            yield (part, sent_keys[k0:k1].tobytes(), _ascending(sent_ids[k0:k1]), digests[g0:g1].tobytes(),
                   docs[d0:d1].tobytes())


def _found(table: pa.Table) -> pa.Table:
    """One part: keys that several batches sent, equal sets, and the rest passed through."""
    def joined(name, kind, width=1):
        raw = b"".join(v.as_buffer().to_pybytes() for v in table.column(name))
        out = np.frombuffer(raw, kind)
        return out.reshape(-1, width) if width > 1 else out

    out = [joined("docs", np.int64, 4)]
    keys = joined("keys", np.uint64)
    ids = np.concatenate([_ids(v.as_buffer()) for v in table.column("key_ids")])
    # The keys of a part are many: a sub-range at a time, which has all of a key.
    sub = (keys >> np.uint64(64 - KEY_RANGE_BITS)).astype(np.uint8)
    for i in range(1 << KEY_RANGE_BITS):
        here = sub == i
        some, owner = keys[here], ids[here]
        order = np.lexsort((owner, some))
        some, owner = some[order], owner[order]
        again = np.zeros(len(some), bool)
        again[1:] = some[1:] == some[:-1]
        at = np.maximum.accumulate(np.where(again, 0, np.arange(len(some)))) if len(some) else order
        out.append(np.stack([np.full(int(again.sum()), MEMBER), some[again].view(np.int64), owner[again],
                             owner[at[again]]], 1))
    del keys, ids, sub
    g = joined("digests", np.int64, 4)
    order = np.lexsort((g[:, 3], g[:, 2], g[:, 1], g[:, 0]))
    g = g[order]
    again = np.zeros(len(g), bool)
    again[1:] = (g[1:, :3] == g[:-1, :3]).all(axis=1)
    at = np.maximum.accumulate(np.where(again, 0, np.arange(len(g)))) if len(g) else order
    out.append(np.stack([np.full(int(again.sum()), COPY), g[again, 3], g[at][again, 3], g[again, 2]], 1))
    rows = np.concatenate(out)
    return pa.table([pa.array(rows[:, 0], pa.int32()), *(pa.array(rows[:, i]) for i in (1, 2, 3))],
                    names=["kind", "a", "b", "c"])


def _keyed(docs: DataFrame, k: int, own_at: tuple[int, int], parts: int) -> DataFrame:
    def run(batches):
        own = scheme(*own_at)
        for batch in text_slices(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for rows in batched(_pack(ids, utf8(batch), k, own, parts), ROWS_AT_ONCE):
                part, *rest = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *(pa.array(c, pa.binary()) for c in rest)],
                                                 names=["part", "keys", "key_ids", "digests", "docs"])
            release()

    return docs.mapInArrow(run, PACKED_SCHEMA).groupBy("part").applyInArrow(_trimmed(_found), FOUND_SCHEMA)


def _trimmed(run):
    """``run`` over a group's rows; the memory that a large group took is given back."""
    def trimmed(rows: pa.Table) -> pa.Table:
        try:
            return run(rows)
        finally:
            if rows.nbytes > LARGE_GROUP:
                release()

    return trimmed


# -- comparison ---------------------------------------------------------------------------

def _sets(docs: DataFrame, k: int) -> DataFrame:
    """``(id, n, bits, tokens)``: the set of each document as packed ascending hashes, its size,
    and a bitmap of its hashes modulo ``BITS``."""
    def run(batches):
        for batch in text_slices(batches):
            values, counts = shingle_sets(utf8(batch), k)
            owner = np.repeat(np.arange(len(counts)), counts)
            bits = np.zeros((len(counts), BITS), bool)
            bits[owner, (values % np.uint64(BITS)).astype(np.int64)] = True
            ends = np.cumsum(counts)
            packed = [values[e - n:e].tobytes() for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array([b.tobytes() for b in np.packbits(bits, axis=1)]),
                 pa.array(packed, pa.binary())], names=["id", "n", "bits", "tokens"])
        release()

    return docs.mapInArrow(run, "id long, n long, bits binary, tokens binary")


def _marked(rows: DataFrame, asked: DataFrame, *on: str) -> DataFrame:
    """``rows`` with ``maybe``: whether the hash of the columns ``on`` is in a broadcast bitmap of those of
    ``asked``. The bitmap's size is fixed; true for all that are asked for and, as it fills, for others."""
    slot = F.pmod(F.xxhash64(*on), F.lit(ID_SLOTS))
    bitmap = (asked.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")))
    byte = F.expr("cast(conv(hex(substring(bitmap, cast(place div 8 AS int) + 1, 1)), 16, 10) AS int)")
    maybe = F.coalesce(F.getbit(byte, F.expr("cast(place % 8 AS int)")) == 1, F.lit(False))
    return (rows.select("*", F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("place"))
            .join(F.broadcast(bitmap), "bucket", "left").select(*rows.columns, maybe.alias("maybe")))


def _near_only(rows: DataFrame, asked: DataFrame, *on: str) -> DataFrame:
    """The rows whose columns ``on`` are in ``asked``, and some others: for steps that others only cost."""
    return _marked(rows, asked, *on).filter("maybe").select(*rows.columns)


def _only(rows: DataFrame, asked: DataFrame, *on: str) -> DataFrame:
    """The rows whose columns ``on`` are in ``asked`` (distinct). A bitmap of their hashes, of fixed
    size, keeps most other rows from the join's shuffle; where many fill it, only the join decides."""
    # An inner join with distinct rows: a semi join would be pushed below the bitmap.
    return _near_only(rows, asked, *on).join(asked.select(*on), list(on))


def without(rows: DataFrame, dropped: DataFrame, on: str) -> DataFrame:
    """The rows whose column ``on`` (never null) is not in ``dropped``. Rows that the bitmap of
    ``dropped`` rules out stay where they are; only the others move, for the join to decide."""
    marked = _marked(rows, dropped, on)
    unsure = marked.filter("maybe").join(dropped.select(F.col(on), F.lit(True).alias("dropped")).distinct(), on, "left")
    return (marked.filter("NOT maybe").select(*rows.columns)
            .unionByName(unsure.filter("dropped IS NULL").select(*rows.columns)))


def _common(a: bytes, b: bytes) -> int:
    x = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    x.sort()
    return int((x[1:] == x[:-1]).sum())


def _pair_filter(pairs: DataFrame, sets: DataFrame, column: str, keep) -> DataFrame:
    """The pairs ``(x, y)`` whose two values of ``column`` and sizes pass ``keep``."""
    left = sets.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col(column).alias("vx"))
    right = sets.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col(column).alias("vy"))

    def run(batches):
        for batch in batches:
            x, y, nx, ny, vx, vy = batch.columns
            hit = [keep(a.as_buffer(), b.as_buffer(), n, m)
                   for a, b, n, m in zip(vx, vy, nx.to_pylist(), ny.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([x, y], names=["x", "y"]).filter(pa.array(hit, pa.bool_()))
        release()

    return (pairs.join(left, "x").join(right, "y").select("x", "y", "nx", "ny", "vx", "vy")
            .mapInArrow(run, "x long, y long"))


def _verified(pairs: DataFrame, sets: DataFrame, own_at: tuple[int, int]) -> DataFrame:
    """The pairs ``(x, y)`` that link. Sizes and bitmaps, which bound the overlap from above,
    rule most others out before whole sets are moved."""
    own = scheme(*own_at)

    def may_link(a, b, n, m):
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        # Every bit of one that the other lacks is a token of its own.
        most = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
        return own.linked(most, n, m)

    pairs = materialize(_pair_filter(pairs, sets, "bits", may_link), "jaccard-likely")
    sets = _only(sets.select("id", "n", "tokens"), pairs.selectExpr("explode(array(x, y)) AS id").distinct(), "id")
    return _pair_filter(pairs, sets, "tokens", lambda a, b, n, m: own.linked(_common(a, b), n, m))


def _sized(queries: DataFrame, of: DataFrame, sets: DataFrame, at: tuple[int, int]) -> DataFrame:
    """The queries ``(x, asked)`` that the sizes of a group's members leave open."""
    own = scheme(*at)
    n = sets.select("id", "n")
    bounds = of.join(n, "id").groupBy(F.col("g").alias("asked")).agg(F.min("n").alias("low"), F.max("n").alias("high"))
    fits = (F.col("n") * own.num <= F.col("high") * own.den) & (F.col("low") * own.num <= F.col("n") * own.den)
    return queries.join(bounds, "asked").join(n.withColumnRenamed("id", "x"), "x").filter(fits).select("x", "asked")


def _near(own: Scheme):
    """Group by group: the queries that a bitmap of the group's token union leaves open and that sizes
    and bitmaps, which bound the overlap from above, let link with members of another component; and
    these members."""
    def run(rows: pa.Table) -> pa.Table:
        asks = rows.column("asks").to_numpy()
        ids, comps, n = (rows.column(c).to_numpy() for c in ("id", "comp", "n"))
        bits = np.frombuffer(b"".join(b.as_buffer() for b in rows.column("bits")), np.uint64).reshape(len(ids), -1)
        members, m_n, m_comp = bits[~asks], n[~asks], comps[~asks]
        union = np.bitwise_or.reduce(members, axis=0)
        asking = np.flatnonzero(asks)
        lacks = np.bitwise_count(bits[asking] & ~union).sum(axis=1, dtype=np.int64)
        near, wanted = [], np.zeros(len(members), bool)
        for q in asking[own.den * (n[asking] - lacks) >= own.num * n[asking]].tolist():
            other = np.flatnonzero(m_comp != comps[q])
            held, size = members[other], m_n[other]
            most = np.minimum(n[q] - np.bitwise_count(bits[q] & ~held).sum(axis=1, dtype=np.int64),
                              size - np.bitwise_count(held & ~bits[q]).sum(axis=1, dtype=np.int64))
            may = (own.den * most >= own.num * (n[q] + size - most)) & (most > 0)
            if may.any():
                near.append(q)
                wanted[other[may]] = True
        out = np.concatenate([np.array(near, np.int64), np.flatnonzero(~asks)[wanted]])
        return rows.select(["asked", "fan", "id", "comp", "asks"]).take(pa.array(out))

    return run


def _compare(own: Scheme):
    """Group by group: the union of the group's tokens, the queries whose tokens it holds
    enough of, and for these the exact overlap with every member. One link per query and
    component of members is enough."""
    def run(rows: pa.Table) -> pa.Table:
        members, queries = rows.filter(pc.invert(rows.column("asks"))), rows.filter(rows.column("asks"))
        ids, comps = (members.column(c).to_numpy() for c in ("id", "comp"))
        arrays = [np.frombuffer(t.as_buffer(), np.uint64) for t in members.column("tokens")]
        sizes = np.array([len(a) for a in arrays], dtype=np.int64)
        x, y = [], []
        if len(ids) and queries.num_rows:
            tokens = np.concatenate(arrays)
            order = np.argsort(tokens, kind="stable")
            tokens = tokens[order]
            new = np.ones(len(tokens), bool)
            new[1:] = tokens[1:] != tokens[:-1]
            start = np.flatnonzero(new)
            union, held = tokens[start], np.diff(np.append(start, len(tokens)))
            holder = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[order]
            del tokens, order, new
            for q, raw in zip(queries.column("id").to_pylist(), queries.column("tokens"), strict=True):
                asked = np.frombuffer(raw.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(union, asked), len(union) - 1)
                at = at[union[at] == asked]
                if own.den * len(at) < own.num * len(asked):
                    continue                                    # the group stays closed
                common = np.zeros(len(ids), np.int64)
                # A bounded number of places at a time (a token has at most one place a member).
                for some in np.split(at, np.flatnonzero(np.diff(np.cumsum(held[at]) // PLACES_AT_ONCE)) + 1):
                    n = held[some]
                    places = np.repeat(start[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    common += np.bincount(holder[places], minlength=len(ids))
                hit = (own.den * common >= own.num * (sizes + len(asked) - common)) & (ids != q) & (common > 0)
                if hit.any():
                    _, one = np.unique(comps[hit], return_index=True)
                    y += ids[hit][one].tolist()
                    x += [q] * len(one)
        return pa.table([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"])

    return run


def link_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs(doc_id, text, …)`` → ``(doc_id, n_shingles, component_id)``, one row per input row.

    Documents link when ``den * |A ∩ B| >= num * |A ∪ B|`` over their distinct k-word
    shingles; ``component_id`` is the smallest doc_id reachable by links. Null and empty
    texts have empty sets and link with nothing. Rows of one doc_id are one node. A null
    doc_id takes no part in links and has a null component. ``num/den`` is at least 0.76.
    """
    spark: SparkSession = docs.sparkSession
    at = (num, den)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(MIN_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Batches of one slice: what a task holds does not follow the length of its texts.
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES)):
        found = materialize(_keyed(docs.filter("doc_id IS NOT NULL"), k, at, parts), "jaccard-found")
    rows = found.filter(F.col("kind") == DOC).selectExpr("a AS doc_id", "b AS n_shingles", "c AS stands")
    # Equal sets of several batches.
    copies = found.filter(F.col("kind") == COPY).selectExpr("a AS id", "b AS of")
    member = found.filter(F.col("kind") == MEMBER).selectExpr("a AS key", "b AS x", "c AS y")
    pairs = (member.filter("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
             .groupBy("x", "y").agg(F.count("*").alias("votes")))
    pairs = materialize(pairs, "jaccard-pairs")
    # A document that equals one of another batch goes as that one: it has the same keys and links.
    # Not so where rows of its doc_id hold several sets.
    once = rows.groupBy("doc_id").count().filter("`count` = 1").select(F.col("doc_id").alias("id"))
    same = materialize(copies.join(once, "id"), "jaccard-same")
    merged = materialize(_merged(pairs, same), "jaccard-merged")
    asked = merged.selectExpr("explode(array(x, y)) AS doc_id").distinct()
    # Rows hold two sets.
    with (setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "500"),
          setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))):
        # Sets of a few others too: the exact join would move whole texts.
        sets = materialize(_sets(_near_only(docs, asked, "doc_id"), k), "jaccard-sets")
        links = materialize(_verified(merged.select("x", "y"), sets, at), "jaccard-links")
        more = _cross_links(member, pairs, same, merged, links, sets, at)
    own_copies = rows.filter("doc_id <> stands AND n_shingles > 0").selectExpr("doc_id AS src", "stands AS dst")
    edges = (links.selectExpr("x AS src", "y AS dst").unionByName(more.selectExpr("x AS src", "y AS dst"))
             .unionByName(own_copies).unionByName(copies.selectExpr("id AS src", "of AS dst")))
    labels = components(edges, "jaccard-components")
    out = (rows.select("doc_id", "n_shingles").join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
           .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    unnamed = (_sets(docs.filter("doc_id IS NULL"), k)
               .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))
    return out.unionByName(unnamed)


def _merged(pairs: DataFrame, same: DataFrame) -> DataFrame:
    """The pairs ``(x, y, votes)`` with each ``id`` of ``same`` replaced by what it equals."""
    a, b = same.selectExpr("id AS x", "of AS as_x"), same.selectExpr("id AS y", "of AS as_y")
    x, y = F.coalesce("as_x", "x"), F.coalesce("as_y", "y")
    return (pairs.join(a, "x", "left").join(b, "y", "left").select(F.greatest(x, y).alias("x"), F.least(x, y).alias("y"), "votes")
            .filter("x <> y").groupBy("x", "y").agg(F.sum("votes").alias("votes")))


def _cross_links(member: DataFrame, pairs: DataFrame, same: DataFrame, merged: DataFrame, links: DataFrame,
                 sets: DataFrame, at: tuple[int, int]) -> DataFrame:
    """Links between different components of ``links`` that share a key. ``member`` and ``pairs`` name
    documents, ``merged`` and ``links`` only what they equal (``same``)."""
    comps = components(links.selectExpr("x AS src", "y AS dst"), "jaccard-groups")
    # A group: a component, or the lone documents that share most keys with one partner.
    both = merged.selectExpr("x AS id", "y AS hub", "votes").unionByName(merged.selectExpr("y AS id", "x AS hub", "votes"))
    hubs = both.groupBy("id").agg(F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("hub"))
    # A partner is often the first of its batch only: its own partner, if smaller, is the first of all.
    hubs = materialize(hubs, "jaccard-hubs")
    upper = hubs.select(F.col("id").alias("hub"), F.least("id", "hub").alias("first"))
    named = (hubs.join(comps.selectExpr("node AS id", "component AS comp"), "id", "left")
             .join(upper, "hub").join(comps.selectExpr("node AS hub", "component AS hub_comp"), "hub", "left")
             .join(comps.selectExpr("node AS first", "component AS first_comp"), "first", "left")
             .select("id", F.coalesce("comp", "id").alias("comp"), F.col("comp").isNotNull().alias("linked"),
                     F.coalesce("comp", "hub_comp", "first_comp", "first").alias("grp")))
    slots = named.groupBy("grp", "linked").agg(F.ceil(F.count("*") / GROUP_SIZE).alias("slots"))
    places = materialize(named.join(slots, ["grp", "linked"])
                         .select("id", "comp", "grp", "linked", F.pmod(F.xxhash64("id"), "slots").alias("slot")),
                         "jaccard-places")
    # Where all members of a key are of the component of the one they were compared with, the
    # key has nothing to ask.
    comp = _with_same(places.select("id", "comp"), same)
    apart = (pairs.select("x", "y").join(comp.selectExpr("id AS x", "comp AS comp_x"), "x")
             .join(comp.selectExpr("id AS y", "comp AS comp_y"), "y").filter("comp_x <> comp_y").select("x", "y"))
    open_keys = _only(member, materialize(apart, "jaccard-apart"), "x", "y").select("key").distinct()
    member = _only(member, materialize(open_keys, "jaccard-open-keys"), "key")
    group = ["grp", "linked", "slot"]
    sizes = places.groupBy(*group).agg(F.count("*").alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    sized = places.join(sizes, group).select("id", F.struct(*group).alias("g"), "size", "low", "high")
    # Every row names a member of its key; the one it was found by is named many times over.
    sized = _with_same(sized, same)
    holders = member.selectExpr("key", "x AS id").unionByName(member.selectExpr("key", "y AS id").distinct())
    held = materialize(holders.join(sized, "id").select("key", "g", "size", "low", "high").distinct(), "jaccard-held")
    # Groups that share a key: the smaller asks the larger; a group of several components
    # asks itself. Two groups of one and the same component have nothing to ask.
    a, b = held.alias("a"), held.alias("b")
    meets = ((F.col("a.key") == F.col("b.key"))
             & ((F.col("a.size") < F.col("b.size")) | ((F.col("a.size") == F.col("b.size")) & (F.col("a.g") <= F.col("b.g"))))
             & (F.least("a.low", "b.low") < F.greatest("a.high", "b.high")))
    asks = materialize(a.join(b, meets).select(F.col("a.g").alias("asker"), F.col("b.g").alias("asked")).distinct(),
                       "jaccard-asks")
    of = places.select("id", "comp", F.struct(*group).alias("g"))
    queries = asks.join(of.selectExpr("g AS asker", "id AS x"), "asker").select("x", "asked")
    queries = materialize(_sized(queries, of, sets, at), "jaccard-queries")
    # In an open group, a query goes on if sizes and bitmaps let it link with a member of another
    # component, and with it the members that it may link with.
    rows = _rows(queries, of, "jaccard-rows")
    near = (rows.join(sets.select("id", "n", "bits"), "id").groupBy("asked", "fan")
            .applyInArrow(_trimmed(_near(scheme(*at))), rows.schema))
    rows = materialize(near, "jaccard-near")
    # Members and queries fetch their sets in one join: the sets move once.
    sets = _near_only(sets.select("id", "tokens"), rows.select("id").distinct(), "id")
    found = rows.join(sets, "id").groupBy("asked", "fan").applyInArrow(_trimmed(_compare(scheme(*at))), "x long, y long")
    return materialize(found, "jaccard-cross")


def _with_same(places: DataFrame, same: DataFrame) -> DataFrame:
    """``places(id, …)`` and, for each ``id`` of ``same``, the place of what it equals."""
    return places.unionByName(same.join(places.withColumnRenamed("id", "of"), "of").drop("of"))


def _rows(queries: DataFrame, of: DataFrame, tag: str) -> DataFrame:
    """``(asked, fan, id, comp, asks)``: the queries of each group, and its members. Queries of a
    much-asked group go to several tasks."""
    fans = materialize(queries.groupBy("asked").agg(F.ceil(F.count("*") / QUERIES_AT_ONCE).cast("int").alias("fans")),
                       "jaccard-fans")
    asking = (queries.join(fans, "asked").withColumn("fan", F.pmod(F.xxhash64("x"), "fans").cast("int"))
              .join(of.selectExpr("id AS x", "comp"), "x")
              .select("asked", "fan", F.col("x").alias("id"), "comp", F.lit(True).alias("asks")))
    members = (of.join(fans.withColumnRenamed("asked", "g"), "g")
               .select(F.col("g").alias("asked"), F.explode(F.sequence(F.lit(0), F.col("fans") - 1)).alias("fan"),
                       "id", "comp", F.lit(False).alias("asks")))
    return materialize(asking.unionByName(members), tag)
