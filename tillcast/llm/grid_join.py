"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are turned onto the principal axes of a bounded sample and sorted by their
grid cells (width epsilon, the distance that belongs to the cosine threshold) on the
leading axes. The sorted sequence is cut into blocks with bounding boxes. Intervals of
blocks are joined recursively, halving both sides; pairs of intervals whose boxes lie
farther apart than epsilon are skipped. The pairs of intervals that remain are joined in
rounds: a round moves about as many bytes as the blocks have, each pair to one task, and
its shuffle files go before the next. In a task the recursion goes on down to small tiles.
Of these a product of single precision, of the leading axes and the length of the rest,
bounds the cosines from above; pairs it cannot rule out are compared in double precision.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tillcast.llm.common import components, running_total, setting
from tillcast.llm.vectors import arrow_rows, dimension, matrix, rows_of
from tillcast.session import checkpoint_dir, materialize

# Vectors the axes are taken from, those of the smallest id hash. Any axes give right results.
AXES_SAMPLE = 4096
GRID_AXES, BOX_AXES = 4, 16
BLOCK, TILE = 1024, 128
TOP_INTERVALS = 16
# An interval of the join: a share of the vectors, within these vectors and bytes (compared in memory).
INTERVALS, LEAST_VECTORS, INTERVAL_BYTES = 16, 4096, 16 << 20
# A round moves the bytes of all blocks, within these.
LEAST_ROUND, MOST_ROUND = 256 << 20, 64 << 30
# Rows of the one side that are compared with a block of the other at once.
LEAF = 512
_SLACK = 1e-9

BLOCK_SCHEMA = "part int, seq int, rows int, low array<double>, high array<double>, ids binary, vectors binary"
LINK_SCHEMA = "vec_id long, n long, root long"


def principal_axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes (columns) by descending spread, from the bounded sample, and the sample on them."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(AXES_SAMPLE).toArrow()
    _, x = matrix(sample.column("embedding").combine_chunks(), dim)
    if not len(x):
        return np.eye(dim), x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    value, vector = np.linalg.eigh(np.cov(x.T) if len(x) > 1 else np.eye(dim))
    axes = vector[:, np.argsort(-value, kind="stable")]
    return axes, x @ axes


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _binary(x: np.ndarray) -> pa.Array:
    """The rows' bytes."""
    ends = np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1] * x.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(x))])


def _heads(turned: np.ndarray, head: int) -> np.ndarray:
    """The leading ``head`` components and the length of the rest: their products are at least the
    vectors' own, but for rounding."""
    rest = np.linalg.norm(turned[:, head:], axis=1)
    return np.column_stack([turned[:, :head], rest]).astype(np.float32)


def _rounding(head: int) -> float:
    """More than the products of ``_heads`` lose in single precision."""
    return (head + 8) * 2.0 ** -23


def _head(sample: np.ndarray, cosine: float) -> int:
    """How many leading components the bound uses: the fewest operations on the sample's pairs, a
    product costing 12 and its parts 1 each, a pair that is not ruled out 20000. Any number gives
    right results."""
    dim = sample.shape[1]
    left, right = sample[:256], sample[256:]
    if not len(right):
        return dim
    others = left @ right.T < cosine
    best = {}
    for head in [*range(4, dim, 4), dim]:
        kept = _heads(left, head) @ _heads(right, head).T >= cosine - _rounding(head)
        best[head] = 12 + head + 20000 * (kept & others).mean()
    return min(best, key=best.get)


def _blocks(vectors: DataFrame, dim: int, axes: np.ndarray, epsilon: float, kind: str) -> DataFrame:
    """Blocks of the sorted sequence; their vectors as given, in numbers of ``kind``."""
    cells = [f"c{i}" for i in range(min(GRID_AXES, dim))]

    def place(batches):
        for batch in batches:
            rows, x = matrix(batch.column(1), dim)
            grid = np.floor(_unit(x) @ axes[:, :len(cells)] / epsilon).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), *(pa.array(grid[:, i]) for i in range(len(cells))),
                 _binary(x.astype(kind))], names=["vec_id", *cells, "v"])

    def cut(batches):
        ids, parts, part, seq = [], [], 0, 0

        def block():
            raw = b"".join(parts)
            turned = _unit(np.frombuffer(raw, kind).reshape(-1, dim)) @ axes[:, :BOX_AXES]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)], pa.int32()),
                 pa.array([turned.min(axis=0).tolist()]), pa.array([turned.max(axis=0).tolist()]),
                 pa.array([np.array(ids, np.int64).tobytes()]), pa.array([raw])],
                names=["part", "seq", "rows", "low", "high", "ids", "vectors"])

        for batch in batches:
            for p, i, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = p
                ids.append(i)
                parts.append(v)
                if len(ids) == BLOCK:
                    yield block()
                    ids, parts, seq = [], [], seq + 1
        if ids:
            yield block()

    placed = vectors.mapInArrow(place, "vec_id long, " + ", ".join(f"{c} int" for c in cells) + ", v binary")
    return (placed.repartitionByRange(*cells, "vec_id").sortWithinPartitions(*cells, "vec_id")
            .select(F.spark_partition_id().alias("part"), "vec_id", "v").mapInArrow(cut, BLOCK_SCHEMA))


def _near(epsilon: float):
    gaps = F.transform(F.arrays_zip("low_i", "high_i", "low_j", "high_j"),
                       lambda z: F.greatest(F.lit(0.0), z["low_i"] - z["high_j"], z["low_j"] - z["high_i"]))
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= epsilon ** 2 + _SLACK


def _spans(boxes: DataFrame, level: int, side: str) -> DataFrame:
    """The boxes of the intervals of ``2 ** level`` blocks, as one side of ``_near``."""
    return boxes.groupBy(F.floor(F.col("n") / (1 << level)).alias(side)).agg(
        *(F.array(*[f(F.col(c)[a]) for a in range(BOX_AXES)]).alias(f"{c}_{side}")
          for c, f in (("low", F.min), ("high", F.max))))


def _interval_pairs(boxes: DataFrame, blocks: int, epsilon: float, lowest: int = 0) -> DataFrame:
    """Pairs ``(i <= j)`` of numbers of intervals of ``2 ** lowest`` blocks whose boxes are within
    epsilon, by recursion from few long intervals."""
    spark = boxes.sparkSession
    level = max(lowest, math.ceil(math.log2(max(1, blocks) / TOP_INTERVALS)))
    top = -(-blocks // (1 << level))
    pairs = (spark.range(top).withColumnRenamed("id", "i")
             .select("i", F.explode(F.sequence("i", F.lit(top - 1).cast("long"))).alias("j")))
    while True:
        sides = [_spans(boxes, level, s) for s in "ij"]
        pairs = materialize(pairs.join(sides[0], "i").join(sides[1], "j").filter(_near(epsilon)).select("i", "j"),
                            "grid-pairs")
        if level == lowest:
            return pairs
        level -= 1
        half = F.array(F.lit(0), F.lit(1))
        pairs = (pairs.withColumn("a", F.explode(half)).withColumn("b", F.explode(half))
                 .select((F.col("i") * 2 + F.col("a")).alias("i"), (F.col("j") * 2 + F.col("b")).alias("j"))
                 .filter("i <= j"))


def _sent(boxes: DataFrame, pairs: DataFrame, level: int, epsilon: float) -> DataFrame:
    """``(i, j, side, n, bytes)``: the blocks ``n`` that the task of a pair of intervals needs, those
    of the one interval (side 0) within epsilon of the other's box and the other way round."""
    own = F.floor(F.col("n") / (1 << level))
    out = []
    for side, (mine, other) in enumerate(("ij", "ji")):
        one = boxes.select("n", "bytes", own.alias(mine), F.col("low").alias(f"low_{mine}"),
                           F.col("high").alias(f"high_{mine}"))
        out.append(pairs.join(_spans(boxes, level, other), other).join(one, mine).filter(_near(epsilon))
                   .select("i", "j", F.lit(side).alias("side"), "n", "bytes"))
    return out[0].unionByName(out[1])


def _in_rounds(sent: DataFrame, most: int) -> DataFrame:
    """``(i, j, round, slot)``: pairs of intervals, numbered in rounds of about ``most`` bytes."""
    cells = materialize(sent.groupBy("i", "j").agg(F.sum("bytes").alias("bytes"), F.countDistinct("side").alias("sides"))
                        .filter("sides = 2"), "grid-cells")
    bases = running_total(cells.groupBy("i").agg(F.sum("bytes").alias("c")), "i", "c").select("i", "base")
    before = Window.partitionBy("i").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("base") + F.coalesce(F.sum("bytes").over(before), F.lit(0))
    return (cells.join(bases, "i").withColumn("round", F.floor(at / most))
            .withColumn("slot", F.row_number().over(Window.partitionBy("round").orderBy("i", "j")) - 1)
            .select("i", "j", "round", "slot"))


class _Tiles:
    """Blocks in memory: vectors as they are kept, what bounds their products, and tiles with boxes."""

    def __init__(self, blocks: list[dict], dim: int, axes: np.ndarray, head: int, kind: str):
        self.ids = np.concatenate([np.frombuffer(b["ids"], np.int64) for b in blocks])
        self.raw = np.concatenate([np.frombuffer(b["vectors"], kind) for b in blocks]).reshape(-1, dim)
        self.start, at, norms, heads, low, high = {}, [0], [], [], [], []
        for b in blocks:
            self.start[b["n"]] = begin = at[-1]
            own = np.frombuffer(b["vectors"], kind).reshape(-1, dim).astype(np.float64)
            norms.append(np.linalg.norm(own, axis=1, keepdims=True))
            turned = own / norms[-1] @ axes
            heads.append(_heads(turned, head))
            cuts = range(0, len(turned), TILE)
            low.append(np.minimum.reduceat(turned[:, :BOX_AXES], cuts))
            high.append(np.maximum.reduceat(turned[:, :BOX_AXES], cuts))
            at.extend(begin + min(c + TILE, len(turned)) for c in cuts)
        self.heads, self.low, self.high = np.concatenate(heads), np.concatenate(low), np.concatenate(high)
        self.at, self.norms = np.array(at), np.concatenate(norms)

    def unit(self, rows: np.ndarray) -> np.ndarray:
        return self.raw[rows].astype(np.float64) / self.norms[rows]

    def rows(self, tiles: np.ndarray, first: int = 0) -> slice | np.ndarray:
        """The rows of the tiles that are set, counted from tile ``first``."""
        begin = self.at[first]
        if tiles.all():
            return slice(begin, self.at[first + len(tiles)])
        return begin + np.flatnonzero(np.repeat(tiles, np.diff(self.at[first:first + len(tiles) + 1])))


def _far(low_x, high_x, low_y, high_y, epsilon: float):
    gap = np.maximum(0, np.maximum(low_x - high_y, low_y - high_x))
    return (gap * gap).sum(axis=-1) > epsilon ** 2 + _SLACK


def _join_tiles(x: _Tiles, y: _Tiles, first: int, last: int, cosine: float, epsilon: float, space: tuple,
                before: int | None = None):
    """Recursive join of the tiles ``first`` to ``last`` of ``x`` with ``y``: yields row numbers of
    both sides and the matrix of links between them, or None where they are linked row by row.
    ``before``: ``y`` begins at this row of ``x``, and only pairs of an earlier row with a later
    one count."""
    if _far(x.low[first:last].min(0), x.high[first:last].max(0), y.low.min(0), y.high.max(0), epsilon):
        return
    if last - first > 1 and x.at[last] - x.at[first] > LEAF:
        middle = (first + last) // 2
        yield from _join_tiles(x, y, first, middle, cosine, epsilon, space, before)
        yield from _join_tiles(x, y, middle, last, cosine, epsilon, space, before)
        return
    near = ~_far(x.low[first:last, None], x.high[first:last, None], y.low[None], y.high[None], epsilon)
    if not near.any():
        return
    rows, columns = x.rows(near.any(axis=1), first), y.rows(near.any(axis=0))
    left, right = x.heads[rows], y.heads[columns]
    shape = len(left), len(right)
    size = shape[0] * shape[1]
    bounds, kept = space
    if len(bounds) < size:
        bounds.resize(size, refcheck=False)
        kept.resize(-(-size // 8) * 8, refcheck=False)
    kept[-(-size // 8) * 8 - 8:] = False
    np.matmul(left, right.T, out=bounds[:size].reshape(shape))
    np.greater_equal(bounds[:size], np.float32(cosine - _rounding(left.shape[1] - 1)), out=kept[:size])
    count = np.count_nonzero(kept[:size])
    if not count:
        return
    rows, columns = (np.arange(s.start, s.stop) if isinstance(s, slice) else s for s in (rows, columns))
    if count * 16 > size:
        links = x.unit(rows) @ y.unit(columns).T >= cosine
        if before is not None:
            links &= rows[:, None] < before + columns[None, :]
        some = links.any(axis=1), links.any(axis=0)
        if some[0].any():
            yield rows[some[0]], columns[some[1]], links[np.ix_(*some)]
        return
    eights = kept[:-(-size // 8) * 8].reshape(-1, 8)
    some = np.flatnonzero(eights.view(np.int64) != 0)      # few: eight at a time
    e, f = np.nonzero(eights[some])
    flat = some[e] * 8 + f
    a, b = rows[flat // shape[1]], columns[flat % shape[1]]
    for k in range(0, len(a), 8192):
        r, c = a[k:k + 8192], b[k:k + 8192]
        linked = np.einsum("ij,ij->i", x.unit(r), y.unit(c)) >= cosine
        if before is not None:
            linked &= r < before + c
        if linked.any():
            yield r[linked], c[linked], None


def _local_roots(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label reachable from each vector along the links of one pair of tiles."""
    a, b, big = left.copy(), right.copy(), np.iinfo(np.int64).max
    while True:
        na = np.minimum(a, np.where(links, b[None, :], big).min(axis=1, initial=big))
        nb = np.minimum(b, np.where(links, na[:, None], big).min(axis=0, initial=big))
        if (na == a).all() and (nb == b).all():
            return a, b
        a, b = na, nb


def _add_links(r, c, links, counts, n, labels, own) -> tuple[np.ndarray, np.ndarray]:
    """Counts the links between rows ``r`` and ``c`` (a matrix, or row by row) and spreads the smallest
    labels along them. Gives the labels that changed, old and new: other vectors may still have
    the old ones."""
    old = labels[r], own[c]
    if links is not None:
        counts[r] += links.sum(axis=1)
        n[c] += links.sum(axis=0)
        labels[r], own[c] = _local_roots(links, *old)
    else:
        np.add.at(counts, r, 1)
        np.add.at(n, c, 1)
        while ((a := labels[r]) != (b := own[c])).any():
            least = np.minimum(a, b)
            np.minimum.at(labels, r, least)
            np.minimum.at(own, c, least)
    old, new = np.concatenate(old), np.concatenate([labels[r], own[c]])
    changed = old != new
    return old[changed], new[changed]


def _compared(rows, dim: int, axes: np.ndarray, head: int, kind: str, cosine: float, epsilon: float):
    """``rows``, blocks by pair of intervals with side 0 first, to ``(vec_id, n, root)``: the number of
    a vector's links in a pair and a vector reached by them; ``n`` 0 where two roots are one component."""
    x, pair, waiting, space = None, None, [], (np.empty(0, np.float32), np.empty(0, bool))

    def ended():
        hit = counts > 0
        found.append((x.ids[hit], counts[hit], labels[hit]))
        old, new = (np.concatenate(c) for c in zip(*joined, strict=True)) if joined else (np.empty(0, np.int64),) * 2
        order = np.lexsort((new, old))
        old, new = old[order], new[order]
        first = np.ones(len(old), bool)
        first[1:] = (old[1:] != old[:-1]) | (new[1:] != new[:-1])
        found.append((old[first], np.zeros(np.count_nonzero(first), np.int64), new[first]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)],
                                          names=["vec_id", "n", "root"])

    for row in rows:
        if (row["i"], row["j"]) != pair:
            if x is not None:
                yield ended()
            x, pair, waiting = None, (row["i"], row["j"]), []
        if row["side"] == 0:
            waiting.append(row)
            continue
        if x is None:
            x, waiting, found, joined = _Tiles(waiting, dim, axes, head, kind), [], [], []
            counts, labels = np.zeros(len(x.ids), np.int64), x.ids.copy()
        y = _Tiles([row], dim, axes, head, kind)
        n, own, last, before = np.zeros(len(y.ids), np.int64), y.ids.copy(), len(x.at) - 1, None
        if pair[0] == pair[1]:                      # each pair of one interval once
            before = x.start[row["n"]]
            last = int(np.searchsorted(x.at, before + len(y.ids)))
        for r, c, links in _join_tiles(x, y, 0, last, cosine, epsilon, space, before):
            joined.append(_add_links(r, c, links, counts, n, labels, own))
        hit = n > 0
        found.append((y.ids[hit], n[hit], own[hit]))
    if x is not None:
        yield ended()


def near_duplicates(embeddings: DataFrame, cosine: float = 0.9) -> DataFrame:
    """``embeddings(vec_id, embedding, …)`` → ``(vec_id, n_links, component_id, kept)``, one row
    per input row: other vectors with cosine at least ``cosine``, the smallest vec_id
    reachable by such links, and whether that is the vector itself.

    Vectors that are null, zero, hold null or non-finite components or have another number
    of components than most link with nothing. Equal vectors link. Rows of a null vec_id
    take no part (0 links, null component). Rows repeating a vec_id count as vectors of
    their own among the links and as one node of a component."""
    spark = embeddings.sparkSession
    vectors = rows_of(embeddings)
    dim = dimension(vectors)
    nothing = vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                             F.lit(True).alias("kept"))
    if not dim:
        return nothing
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))
    named = vectors.filter("vec_id IS NOT NULL")
    axes, sample = principal_axes(named, dim)
    head = _head(sample, cosine)
    given = embeddings.schema["embedding"].dataType
    kind = "<f4" if isinstance(given, ArrayType) and isinstance(given.elementType, FloatType) else "<f8"
    with arrow_rows(spark, 2000), _shuffle_files_go(spark):
        blocks = materialize(_blocks(named, dim, axes, epsilon, kind), "grid-blocks")
    parts = running_total(blocks.groupBy("part").agg(F.count("*").alias("c"), F.sum("rows").alias("r")), "part", "c")
    parts = materialize(parts.select("part", "base", "c", "r"), "grid-parts")
    total, count = parts.agg(F.sum("c"), F.sum("r")).first()
    if not total:
        return nothing
    numbered = blocks.join(F.broadcast(parts.select("part", "base")), "part").withColumn("n", F.col("base") + F.col("seq"))
    width = dim * np.dtype(kind).itemsize
    boxes = materialize(numbered.select(
        "n", (F.col("rows") * (width + 8)).cast("long").alias("bytes"),
        *(F.concat(c, F.array_repeat(F.lit(0.0), BOX_AXES - min(BOX_AXES, dim))).alias(c) for c in ("low", "high"))),
        "grid-boxes")
    aim = min(max(count // INTERVALS, LEAST_VECTORS), max(1, INTERVAL_BYTES // width))
    level = max(0, round(math.log2(max(1.0, aim / (count / total)))))
    sent = materialize(_sent(boxes, _interval_pairs(boxes, total, epsilon, level), level, epsilon), "grid-sent")
    cells = materialize(_in_rounds(sent, min(max(count * (width + 8), LEAST_ROUND), MOST_ROUND)), "grid-rounds")

    def compare(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        yield from _compared(rows, dim, axes, head, kind, cosine, epsilon)

    path = f"{checkpoint_dir(spark).rstrip('/')}/tillcast-grid-links-{uuid.uuid4().hex}"
    for at, tasks in sorted(tuple(r) for r in cells.groupBy("round").count().collect()):
        todo = sent.join(cells.filter(F.col("round") == at), ["i", "j"]).select("i", "j", "side", "n", "slot")
        moved = (numbered.select("n", "ids", "vectors").join(F.broadcast(todo), "n")
                 .repartitionById(tasks, F.col("slot").cast("int")).sortWithinPartitions("i", "j", "side", "n")
                 .select("i", "j", "side", "n", "ids", "vectors"))
        with arrow_rows(spark, 8), _shuffle_files_go(spark), setting(spark, "spark.sql.parquet.columnarReaderBatchSize", "16"):
            moved.mapInArrow(compare, LINK_SCHEMA).write.mode("append").parquet(path)
    found = spark.read.schema(LINK_SCHEMA).parquet(path)
    counts = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    labels = components(found.selectExpr("vec_id AS src", "root AS dst"), "grid-components")
    return (vectors.select("vec_id").join(counts, "vec_id", "left")
            .join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _shuffle_files_go(spark):
    """Shuffle files of the jobs run inside go as soon as their query has ended."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
