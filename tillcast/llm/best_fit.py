"""Best-fit packing into sequences of several permitted lengths.

Documents become pieces of at most the largest length; pieces are dealt by hash into
shards of bounded size, and each shard is packed on its own: longest piece first, each
into the open bin it leaves the least room in. A piece that fits nowhere opens a bin. The
sizes are chosen jointly: the shard is packed once per opening policy (take the k-th
permitted length that fits, for each k, or the one of least cost per token that the pieces
still to come can fill), every bin is then downsized to the smallest permitted length
that holds its contents, and the packing of least total cost is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import materialize

LENGTHS = (512, 1024, 2048, 4096, 8192)
# Cost of a sequence: its tokens, an attention part that grows with the square (as a
# share of the tokens at ATTENTION_AT) and a fixed part.
ATTENTION_SHARE, ATTENTION_AT, SEQUENCE_COST = 0.25, 8192, 8.0
SHARD_PIECES = 20_000
# Rows equal in document and length are dealt apart beyond this part of a shard.
REPEATS, MAX_BROADCAST_ROWS = 10, 200_000

PACK_SCHEMA = ("doc_id long, piece int, start long, length int, bin_id string, capacity int, used int, "
               "offset int")


def cost(length: int) -> float:
    return SEQUENCE_COST + length * (1 + ATTENTION_SHARE * length / ATTENTION_AT)


def word_count(text: str | Column = "text") -> Column:
    """Tokens of a text: its words (runs of no white space) and one end mark."""
    t = F.trim(F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"\s+", " "))
    return F.when(t == "", 1).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 2)


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> list[tuple[int, list[int]]]:
    """Bins ``(length, indexes of sizes)`` for one shard; every size is at most the
    largest length and at least 1. Equal sizes keep their order."""
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    found = [_pack(sizes, order, lengths, policy) for policy in range(-1, len(lengths))]
    return min(found, key=lambda bins: sum(cost(c) for c, _ in bins))


def _pack(sizes, order, lengths, policy: int) -> list[tuple[int, list[int]]]:
    rooms: dict[int, list[int]] = {}    # room left → open bins
    mask = 0                            # bit r set: a bin with room r is open
    bins: list[list[int]] = []
    used: list[int] = []
    to_come = sum(sizes)
    for i in order:
        size = sizes[i]
        to_come -= size
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = rooms[room].pop()
            if not rooms[room]:
                mask ^= 1 << room
        else:
            open_to = [c for c in lengths if c >= size]
            if policy < 0:
                room = min(open_to, key=lambda c: cost(c) / min(c, size + to_come))
            else:
                room = open_to[min(policy, len(open_to) - 1)]
            at = len(bins)
            bins.append([])
            used.append(0)
        bins[at].append(i)
        used[at] += size
        room -= size
        if room:
            rooms.setdefault(room, []).append(at)
            mask |= 1 << room
    return [(next(c for c in lengths if c >= u), b) for u, b in zip(used, bins, strict=True)]


def best_fit(docs: DataFrame, length: Column | None = None, lengths: Sequence[int] = LENGTHS,
             shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``docs(doc_id, text, …)`` → ``PACK_SCHEMA``, one row per piece: its place in the
    document (``start``, ``length``, in tokens) and in its sequence (``bin_id``,
    ``offset``), the sequence's permitted length ``capacity`` and its tokens ``used``.

    ``length`` gives a document's tokens (default ``word_count``); lengths below 1 or
    null count as 1, so empty and null texts take one token. Longer documents than the
    largest length are cut into whole pieces and a rest; nothing is dropped. A repeated
    row is packed as often as it occurs. A shard holds about ``shard_pieces`` pieces
    whatever the ids are: they are dealt by a hash of document, length and piece, and where
    more than a ``REPEATS``-th of a shard agree in these, by a number of the row as well."""
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    n = F.greatest(F.coalesce((word_count() if length is None else length).cast("long"), F.lit(1)), F.lit(1))
    sized = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n"),
                                    F.monotonically_increasing_id().alias("row")), "packing")
    shards = sized.agg(F.sum(F.ceil(F.col("n") / top))).first()[0] or 0
    shards = max(1, round(shards / shard_pieces))
    # At most REPEATS keys a shard; a hot key's rows are split by AQE where the join is a shuffle.
    often = (sized.groupBy(F.col("doc_id").alias("same_id"), F.col("n").alias("same_n")).agg(F.count("*").alias("c"))
             .filter(F.col("c") > shard_pieces / REPEATS).select("same_id", "same_n"))
    often = materialize(often, "packing-repeats")
    if often.count() <= MAX_BROADCAST_ROWS:
        often = F.broadcast(often)
    salted = (sized.join(often, F.col("doc_id").eqNullSafe(F.col("same_id")) & (F.col("n") == F.col("same_n")), "left")
              .select("doc_id", "n", F.when(F.col("same_n").isNotNull(), F.col("row")).alias("salt")))
    pieces = (salted.select("doc_id", "n", "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / top)))
                           .alias("piece"))
              .select("doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * top).alias("start"),
                      F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * top).cast("int").alias("length"),
                      F.pmod(F.xxhash64("doc_id", "n", "piece", "salt"), F.lit(shards)).alias("shard")))

    def run(shard: pa.Table) -> pa.Table:
        # Arrow keeps ids whole where some are null.
        shard = shard.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece")])
        sizes = shard["length"].to_pylist()
        bin_id, capacity, total, offset = ([None] * len(sizes) for _ in range(4))
        name = shard["shard"][0].as_py()
        for k, (c, members) in enumerate(pack(sizes, lengths)):
            at = 0
            used = sum(sizes[i] for i in members)
            for i in members:
                bin_id[i], capacity[i], total[i], offset[i] = f"{name}-{k}", c, used, at
                at += sizes[i]
        packed = [pa.array(bin_id, pa.string()), *(pa.array(x, pa.int32()) for x in (capacity, total, offset))]
        return pa.table([*(shard[c] for c in ("doc_id", "piece", "start", "length")), *packed],
                        names=[c.split()[0] for c in PACK_SCHEMA.split(", ")])

    return pieces.groupBy("shard").applyInArrow(run, PACK_SCHEMA)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: ``bin_id``, ``capacity``, ``used``, the distinct ``doc_ids`` in
    it and its ``pieces`` in order (bounded by the sequence's length)."""
    part = F.struct("offset", "doc_id", "piece", "start", "length")
    return (packed.groupBy("bin_id", "capacity", "used")
            .agg(F.array_sort(F.collect_list(part)).alias("pieces"), F.array_sort(F.collect_set("doc_id")).alias("doc_ids"))
            .select("bin_id", "capacity", "used", "doc_ids", "pieces"))
