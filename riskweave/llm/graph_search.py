"""Approximate nearest neighbours by a robust-pruned directed graph in every shard.

Equal vectors are one node that lists its smallest ids (k + 1 of them are all
that a top-k list can hold). Nodes are inserted in growing batches: a greedy
beam search over the graph so far proposes neighbours; robust pruning keeps the
nearest candidate p and drops every c with ``alpha * d(p, c) <= d(x, c)``, again
and again, so that edges stay few and point in different directions; edges are
added backwards too, and nodes with too many edges are pruned again. A query
runs a beam search in every shard from the shard's medoid; distances of the
beam are taken anew in double precision on the original vectors and the shards
are merged.

Edge cases: vectors that are null, zero, or hold null or non-finite components
take no part; vectors are compared with those of the same length only; repeated
rows are candidates of their own and only a query's own row is left out; ties
go to smaller ids (null ids last); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import staged
from riskweave.llm.shards import finite, matrix, merge_top, per_shard, search, shard_count

DEGREE, BUILD_BEAM, ALPHA = 32, 64, 1.2
SCHEMA = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def distances(a: np.ndarray, vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distances of a[i] to vectors[at[i, j]]."""
    x = vectors[at]
    x -= a[:, None, :]
    return np.einsum("ijk,ijk->ij", x, x)


def beam_search(vectors, graph, entry, asked, beam, width=2):
    """(ids, squared distances) of the beam of each asked vector, nearest first, and all expanded nodes.

    ``graph`` has -1 where a node has fewer edges. Every step expands the
    ``width`` nearest nodes of each beam that have not been expanded.
    """
    q, n = len(asked), len(vectors)
    ids = np.full((q, beam), -1)
    far = np.full((q, beam), np.inf, vectors.dtype)
    ids[:, 0] = entry
    far[:, 0] = distances(asked, vectors, ids[:, :1])[:, 0]
    open_ = np.zeros((q, beam), bool)
    open_[:, 0] = True
    seen = np.zeros((q, n + 1), bool)  # the last column stands for "no node"
    seen[:, entry] = seen[:, n] = True
    expanded, live = [], np.arange(q)
    while len(live):
        rows = live[:, None]
        order = np.argsort(~open_[live], axis=1, kind="stable")[:, :width]
        use = open_[rows, order]
        nodes = np.where(use, ids[rows, order], -1)
        open_[rows, order] = False
        step = np.full((q, width), -1)
        step[live] = nodes
        expanded.append(step)
        near = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near = np.where(near < 0, n, near)
        new = ~seen[rows, near]
        seen[rows, near] = True
        near[~new] = n
        width_now = max(1, int(new.sum(axis=1).max()))
        near = np.sort(near, axis=1)[:, :width_now]  # new nodes to the front
        real = near < n
        d = np.where(real, distances(asked[live], vectors, np.where(real, near, 0)), np.inf)
        all_d = np.concatenate([far[live], d], axis=1)
        all_i = np.concatenate([ids[live], np.where(real, near, -1)], axis=1)
        all_o = np.concatenate([open_[live], real], axis=1)
        keep = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        line = np.arange(len(live))[:, None]
        far[live], ids[live], open_[live] = all_d[line, keep], all_i[line, keep], all_o[line, keep]
        live = live[open_[live].any(axis=1)]
    return ids, far, np.concatenate(expanded, axis=1)


def robust_prune(vectors, nodes, candidates, degree=DEGREE, alpha=ALPHA):
    """Out-edges of each node from its candidates (-1: none), at most ``degree``."""
    candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    d = np.where(candidates >= 0, distances(vectors[nodes], vectors, np.maximum(candidates, 0)), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    candidates, d = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1)
    width = max(1, int((candidates >= 0).sum(axis=1).max(initial=0)))
    candidates, d = candidates[:, :width], d[:, :width].copy()
    x = vectors[np.maximum(candidates, 0)]
    norm = np.einsum("ijk,ijk->ij", x, x)
    out = np.full((len(nodes), degree), -1)
    for k in range(degree):
        pick = np.argmin(d, axis=1)
        line = np.arange(len(nodes))
        some = np.isfinite(d[line, pick])
        if not some.any():
            break
        out[some, k] = candidates[some, pick[some]]
        p = x[line, pick]
        between = np.maximum(norm + norm[line, pick][:, None] - 2 * np.einsum("ijk,ik->ij", x, p), 0)
        d[alpha * alpha * between <= d] = np.inf
        d[line, pick] = np.inf
    return out


def build_graph(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, int]:
    """Edges of every node (-1: none) and the entry node."""
    n = len(vectors)
    graph = np.full((n, DEGREE), -1)
    middle = vectors.mean(axis=0, keepdims=True)
    entry = int(np.argmin(((vectors - middle) ** 2).sum(axis=1)))
    order = np.random.default_rng(seed).permutation(n)
    order = order[order != entry]
    at, size = 0, 1
    while at < len(order):
        nodes = order[at:at + size]
        at, size = at + size, min(2 * size, max(16, n // 50), 512)
        _, _, proposed = beam_search(vectors, graph, entry, vectors[nodes], BUILD_BEAM)
        graph[nodes] = robust_prune(vectors, nodes, proposed)
        # Backward edges, by target.
        source = np.repeat(nodes, DEGREE)
        target = graph[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        hit, first, count = np.unique(target, return_index=True, return_counts=True)
        wide = np.full((len(hit), DEGREE + int(count.max(initial=0))), -1)
        wide[:, :DEGREE] = graph[hit]
        place = np.arange(len(target)) - np.repeat(first, count)
        wide[np.repeat(np.arange(len(hit)), count), DEGREE + place] = source
        full = (wide >= 0).sum(axis=1) > DEGREE
        if full.any():
            graph[hit[full]] = robust_prune(vectors, hit[full], wide[full])
        if not full.all():
            graph[hit[~full]] = -np.sort(-wide[~full], axis=1)[:, :DEGREE]
    return graph, entry


def build_index(vectors: DataFrame, k: int, is_query: Column, id_col: str, vec_col: str,
                rows_per_shard: int) -> tuple[DataFrame, DataFrame, int]:
    """(graph nodes by shard, valid rows, number of shards); both frames are written copies."""
    rows = staged(vectors.filter(finite(vec_col) & F.exists(vec_col, lambda x: x != 0)).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.size(vec_col).alias("dim"),
        F.transform(vec_col, lambda x: x.cast("double")).alias("vec"))
        .withColumn("row", F.monotonically_increasing_id()), "graph-rows")
    # The k + 1 smallest ids of each distinct vector; in two steps, so that a vector of very many rows is spread.
    member = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    low = rows.select("dim", "vec", member.alias("m"), F.pmod(F.xxhash64("row"), F.lit(64)).alias("salt"))
    for keys in (["vec", "salt"], ["vec"]):
        low = low.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("m"))).filter(F.col("nth") <= k + 1)
    nodes = low.groupBy("dim", "vec").agg(F.array_sort(F.collect_list("m")).alias("members"))
    nodes = staged(nodes.select("dim", "vec", F.col("members.id").alias("ids"), F.col("members.row").alias("rows"),
                                F.col("members")[0]["id"].alias("id"), F.col("members")[0]["row"].alias("row")), "graph-nodes")
    n_shards = shard_count(nodes, rows_per_shard)
    shards = nodes.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int"))

    def build(key, table):
        graph, entry = build_graph(matrix(table.column("vec"), np.float32), seed=key[1])
        edges = pa.array([g[g >= 0].tolist() for g in graph], pa.list_(pa.int32()))
        table = table.append_column("edges", edges).append_column("entry", pa.array(np.arange(len(graph)) == entry))
        yield from table.select(names).to_batches()
    names = ["dim", "shard", "id", "row", "ids", "rows", "vec", "edges", "entry"]
    index = per_shard(shards, build, "dim int, shard int, id long, row long, ids array<long>, rows array<long>, "
                                     "vec array<double>, edges array<int>, entry boolean")
    return staged(index, "graph-index"), rows, n_shards


class Shard:
    def __init__(self, table: pa.Table):
        self.exact = matrix(table.column("vec"), np.float64)
        self.vectors = self.exact.astype(np.float32)
        edges = table.column("edges").combine_chunks()
        counts = np.diff(np.asarray(edges.offsets))
        self.graph = np.full((len(counts), DEGREE), -1)
        self.graph[np.repeat(np.arange(len(counts)), counts),
                   np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = np.asarray(edges.flatten())
        self.entry = int(np.flatnonzero(table.column("entry").to_numpy())[0])
        ids, rows = table.column("ids").combine_chunks(), table.column("rows").combine_chunks()
        self.first, self.ids, self.rows = np.asarray(ids.offsets).astype(np.int64), ids.flatten(), np.asarray(rows.flatten())
        self.first -= self.first[0] if len(self.first) else 0
        last = np.iinfo(np.int64).max
        self.order = np.asarray(self.ids.fill_null(last))


def nearest(vectors: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
            rows_per_shard: int = 16_384, beam: int = 128) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) of the nearest found for each query row."""
    index, rows, n_shards = build_index(vectors, k, is_query, id_col, vec_col, rows_per_shard)
    queries = rows.filter("query").select("dim", "id", "row", "vec")

    def load(key, table):
        return Shard(table)

    def answer(shard, batch):
        asked = matrix(batch.column("vec"), np.float64)
        own = batch.column("row").to_numpy()
        found, _, _ = beam_search(shard.vectors, shard.graph, shard.entry, asked.astype(np.float32), beam)
        who, picks, scores = [], [], []
        for q in range(len(own)):
            nodes = found[q][found[q] >= 0][:4 * k]
            exact = np.sqrt(((shard.exact[nodes] - asked[q]) ** 2).sum(axis=1))
            n = shard.first[nodes + 1] - shard.first[nodes]
            at = np.concatenate([np.arange(shard.first[x], shard.first[x + 1]) for x in nodes])
            d = np.repeat(exact, n)
            other = shard.rows[at] != own[q]
            at, d = at[other], d[other]
            best = np.lexsort((shard.order[at], d))[:k]
            who.append(np.full(len(best), q))
            picks.append(at[best])
            scores.append(d[best])
        who = np.concatenate(who)
        return pa.RecordBatch.from_arrays([pa.array(own[who]), batch.column("id").take(pa.array(who)),
                                           shard.ids.take(pa.array(np.concatenate(picks))),
                                           pa.array(np.concatenate(scores))], schema=SCHEMA)
    found = search(index.select("dim", "shard", "id", "row", "ids", "rows", "vec", "edges", "entry"), queries, n_shards,
                   load, answer, "query_row long, query_id long, vec_id long, score double")
    return merge_top(found, k, F.col("score").asc())
