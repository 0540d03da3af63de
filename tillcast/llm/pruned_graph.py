"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Vectors are dealt to shards by hash. In a shard every vector gets edges: a greedy search
from the shard's centre proposes neighbours, relaxed distance pruning (a neighbour is
dropped when a kept one is ``ALPHA`` times nearer to it than the vector is) keeps near and
diverse ones, and edges are added backwards, pruned again where a vector has too many.
Vectors are inserted in batches, so all searches of a batch run as matrix operations. A
query runs a beam search in every shard; the shards' best are merged.

Nearness is the inner product. The graph is built on vectors lengthened by one component
that gives all the same norm, where the largest inner product is the smallest distance.
Equal vectors are one node with all their ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.vectors import arrow_rows, dimension, matrix, rows_of
from tillcast.session import materialize

SHARD_VECTORS = 4000
DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA = 32, 40, 96, 1.2
INSERT_BATCH, QUERY_BLOCK = 512, 1024


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int):
    """Beam search of many queries at once, nearest first: ``(nodes, squared distances)`` of
    the ``beam`` nearest found (node -1: none), and every node's expansion in order."""
    q, n = len(queries), len(points)
    norms = (points * points).sum(axis=1)
    nodes = np.full((q, beam), -1, np.int64)
    dist = np.full((q, beam), np.inf)
    opened = np.zeros((q, beam), bool)
    seen = np.zeros((q, n), bool)
    nodes[:, 0], seen[:, start] = start, True
    dist[:, 0] = norms[start] - 2 * queries @ points[start]
    active = np.arange(q)
    while len(active):
        waiting = np.where(opened[active] | (nodes[active] < 0), np.inf, dist[active])
        slot = waiting.argmin(axis=1)
        more = np.isfinite(waiting[np.arange(len(active)), slot])
        active, slot = active[more], slot[more]
        if not len(active):
            break
        opened[active, slot] = True
        near = edges[nodes[active, slot]]
        fresh = near >= 0
        fresh &= ~seen[active[:, None], np.maximum(near, 0)]
        seen[active[:, None], np.where(fresh, near, nodes[active, slot][:, None])] = True
        to = np.maximum(near, 0)
        d = norms[to] - 2 * np.matmul(points[to], queries[active][:, :, None])[:, :, 0]
        d[~fresh] = np.inf
        all_d = np.concatenate([dist[active], d], axis=1)
        all_n = np.concatenate([nodes[active], np.where(fresh, near, -1)], axis=1)
        all_o = np.concatenate([opened[active], np.zeros_like(fresh)], axis=1)
        order = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        rows = np.arange(len(active))[:, None]
        dist[active], nodes[active], opened[active] = all_d[rows, order], all_n[rows, order], all_o[rows, order]
    order = np.argsort(dist, axis=1, kind="stable")
    rows = np.arange(q)[:, None]
    return nodes[rows, order], dist[rows, order]


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Edges for the nodes ``own`` from their ``candidates`` (rows; -1: none), nearest first,
    dropping those that a kept one is ``alpha`` times nearer to."""
    rows = np.arange(len(own))
    candidates = np.where(candidates == own[:, None], -1, candidates)
    diff = points[np.maximum(candidates, 0)] - points[own][:, None, :]
    d = (diff * diff).sum(axis=2)
    d[candidates < 0] = np.inf
    order = np.argsort(d, axis=1, kind="stable")
    candidates, d = candidates[rows[:, None], order], d[rows[:, None], order]
    vectors = points[np.maximum(candidates, 0)]
    alive = np.isfinite(d)
    # A node proposed twice is a neighbour once.
    alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    edges = np.full((len(own), degree), -1, np.int64)
    for k in range(degree):
        has = alive.any(axis=1)
        if not has.any():
            break
        pick = alive.argmax(axis=1)
        edges[has, k] = candidates[rows, pick][has]
        diff = vectors - vectors[rows, pick][:, None, :]
        alive &= ~(alpha * alpha * (diff * diff).sum(axis=2) <= d)
        alive[rows, pick] = False
    return edges


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
    """``(edges, start)`` over ``points``: two rounds of batch insertion, the first unrelaxed."""
    n = len(points)
    rng = np.random.default_rng(n)
    start = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = rng.integers(0, n, (n, degree // 2)) if n > 1 else np.full((n, 1), -1)
    edges = np.concatenate([edges, np.full((n, degree - edges.shape[1]), -1)], axis=1).astype(np.int64)
    for a in (1.0, alpha):
        order = rng.permutation(n)
        for at in range(0, n, INSERT_BATCH):
            own = order[at:at + INSERT_BATCH]
            found, _ = beam_search(points, edges, start, points[own], beam)
            edges[own] = robust_prune(points, own, np.concatenate([found, edges[own]], axis=1), degree, a)
            # Backward edges: each target's present edges and its new sources, pruned again.
            source = np.repeat(own, degree)
            target = edges[own].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            hit, first, count = np.unique(target, return_index=True, return_counts=True)
            by = np.argsort(count, kind="stable")       # targets with as many sources together
            hit, first, count = hit[by], first[by], count[by]
            lo = 0
            while lo < len(hit):
                part = slice(lo, min(len(hit), lo + max(1, 4 * INSERT_BATCH // int(count[lo] + 4))))
                lo = part.stop
                new = np.full((len(hit[part]), int(count[part].max())), -1, np.int64)
                for r, (f, c) in enumerate(zip(first[part], count[part], strict=True)):
                    new[r, :c] = source[f:f + c]
                edges[hit[part]] = robust_prune(points, hit[part], np.concatenate([edges[hit[part]], new], axis=1),
                                                degree, a)
    return edges, start


def _lengthened(vectors: np.ndarray) -> np.ndarray:
    norms = (vectors * vectors).sum(axis=1)
    return np.hstack([vectors, np.sqrt(np.maximum(norms.max() - norms, 0.0))[:, None]])


INDEX_SCHEMA = "shard int, n int, start int, ids binary, node binary, vectors binary, edges binary"


def build_index(embeddings: DataFrame, shard_vectors: int = SHARD_VECTORS) -> tuple[DataFrame, int]:
    """``(index, components per vector)``: the written index, one row per shard, holding every
    usable row's vector: not null or zero, all components finite, with an id, of the most
    frequent length among such vectors. Rows of one id are kept apart; an empty table gives
    an empty index."""
    spark = embeddings.sparkSession
    vectors = rows_of(embeddings).filter("vec_id IS NOT NULL")
    dim = dimension(vectors)
    shards = max(1, -(-vectors.count() // shard_vectors))

    def build(table: pa.Table) -> pa.Table:
        rows, x = matrix(table.column("embedding").combine_chunks(), dim)
        names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
        kinds = [pa.int32()] * 3 + [pa.binary()] * 4
        if not len(x):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        ids = table.column("vec_id").to_numpy()[rows]
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        points, node = np.unique(x, axis=0, return_inverse=True)
        edges, start = build_graph(_lengthened(points))
        shard = table.column("shard")[0].as_py()
        values = [shard, len(points), start, ids.tobytes(), node.astype(np.int64).tobytes(), points.tobytes(),
                  edges.tobytes()]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=names)

    index = (vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
             .groupBy("shard").applyInArrow(build, INDEX_SCHEMA))
    with arrow_rows(spark, 2000):
        return materialize(index, "graph-index"), dim


def search(index: DataFrame, dim: int, queries: DataFrame, k: int = 20, beam: int = QUERY_BEAM) -> DataFrame:
    """``queries(vec_id, embedding)`` → ``(query_id, rank, vec_id, score)``: the ``k`` nearest
    found, nearest first, ties to the smaller vec_id, a query's own row left out. Queries
    travel as full blocks of ``QUERY_BLOCK`` rows, each to every shard, so a shard is handed to
    Python once per block. Queries that are null, zero or hold null or non-finite components, have
    no id or another length than the index get no rows; rows of one id count as one query's
    own, and a repeated query row is answered once."""
    spark = index.sparkSession

    def pack(batches):
        for batch in batches:
            rows, x = matrix(batch.column(1), dim)
            if not len(x):
                continue
            ids = batch.column(0).to_numpy()[rows]
            for at in range(0, len(ids), QUERY_BLOCK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[at:at + QUERY_BLOCK].tobytes()]), pa.array([x[at:at + QUERY_BLOCK].tobytes()])],
                    names=["query_ids", "query_vectors"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, node = (np.frombuffer(row[c], np.int64) for c in ("ids", "node"))
                points = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
                edges = np.frombuffer(row["edges"], np.int64).reshape(len(points), -1)
                query_ids = np.frombuffer(row["query_ids"], np.int64)
                q = np.frombuffer(row["query_vectors"], np.float64).reshape(-1, dim)
                found, _ = beam_search(_lengthened(points), edges, row["start"], np.hstack([q, np.zeros((len(q), 1))]),
                                       min(beam, len(points)))
                # Ids by node, ascending; no more than k + 1 equal vectors can be among the k nearest.
                by = np.argsort(node, kind="stable")
                first = np.searchsorted(node[by], np.arange(len(points) + 1))
                out_q, out_v, out_s = [], [], []
                for i, own in enumerate(query_ids):
                    nodes = found[i][found[i] >= 0]
                    scores = (points[nodes] * q[i]).sum(axis=1)
                    # Whole ties: every node found that is no worse than the (k + 1)-th.
                    if len(nodes) > k + 1:
                        good = scores >= np.partition(scores, -(k + 1))[-(k + 1)]
                        nodes, scores = nodes[good], scores[good]
                    parts = [ids[by[first[n]:first[n + 1]][:k + 1]] for n in nodes]
                    v, s = np.concatenate(parts), np.repeat(scores, [len(x) for x in parts])
                    v, s = v[v != own], s[v != own]
                    best = np.lexsort((v, -s))[:k]
                    out_q.append(np.full(len(best), own))
                    out_v.append(v[best])
                    out_s.append(s[best])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)) for a in (out_q, out_v, out_s)],
                                                 names=["query_id", "vec_id", "score"])

    asked = rows_of(queries).filter("vec_id IS NOT NULL")
    # Packed before the small batches below are set: they would cut these blocks too.
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    blocks = materialize(asked.repartition(parts, F.xxhash64("vec_id")).mapInArrow(pack, "query_ids binary, query_vectors binary"),
                         "graph-queries")
    shards = index.agg(F.collect_list("shard")).first()[0]
    blocks = blocks.withColumn("shard", F.explode(F.array(*map(F.lit, shards)) if shards
                                                  else F.array().cast("array<int>")))
    with arrow_rows(spark, 2):
        found = materialize(index.join(blocks, "shard").mapInArrow(run, "query_id long, vec_id long, score double"),
                            "graph-found")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
