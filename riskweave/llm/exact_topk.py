"""Exact top-k by inner product: exhaustive term-at-a-time accumulation.

A component index is a term, its integer value the weight. Every shard keeps
postings (rows and weights) by term. A block of queries walks its terms; each
term scatters query weight x posting weight into the dense score arrays of the
block. A partition selection takes each query's k best of the shard, and a
window merges the shards. All arithmetic is in 64-bit integers; if a shard's
weights could overflow them, Python integers are used and scores are held to
the range of a long.

Edge cases: vectors that are null or hold null or non-finite components take no
part; empty vectors score 0; rows that repeat are rows of their own, and only a
query's own row is left out; ties go to smaller ids (null ids last); fewer than
k candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import staged
from riskweave.llm.shards import finite, matrix, merge_top, search, shard_count

SCHEMA = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


class Postings:
    """Rows and weights of every term of a shard, and the ids in ascending order."""

    def __init__(self, table: pa.Table):
        self.ids, self.rows = table.column("id").combine_chunks(), table.column("row").to_numpy()
        weights = matrix(table.column("vec"), np.int64)
        self.n, self.largest = len(self.rows), int(np.abs(weights.astype(float)).max(initial=0))
        self.lists = []
        for t in range(weights.shape[1]):
            at = np.flatnonzero(weights[:, t])
            # A posting that most rows are in is kept as a dense column.
            self.lists.append((slice(None), weights[:, t].copy()) if 2 * len(at) > self.n else (at, weights[at, t]))

    def scores(self, queries: np.ndarray) -> np.ndarray:
        large = self.largest * float(np.abs(queries.astype(float)).max(initial=0)) * max(1, queries.shape[1]) >= 2.0 ** 62
        kind = object if large else np.int64
        out = np.zeros((len(queries), self.n), kind)
        for t, (rows, weights) in enumerate(self.lists):
            asks = np.flatnonzero(queries[:, t])
            if len(asks) and len(weights):
                gain = np.multiply.outer(queries[asks, t].astype(kind), weights.astype(kind))
                if isinstance(rows, slice):
                    out[asks] += gain
                else:
                    out[np.ix_(asks, rows)] += gain
        return np.clip(out, -2 ** 63, 2 ** 63 - 1).astype(np.int64) if large else out


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest values, largest first, ties to smaller places."""
    n = len(scores)
    if n > k:
        least = np.partition(scores, n - k)[n - k]
        above = np.flatnonzero(scores > least)
        at = np.concatenate([above, np.flatnonzero(scores == least)[:k - len(above)]])
    else:
        at = np.arange(n)
    return at[np.lexsort((at, -scores[at].astype(object) if n and scores.min() == -2 ** 63 else -scores[at]))]


def exact_topk(vectors: DataFrame, k: int, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
               scale: int = 1024, rows_per_shard: int = 65_536) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest integer inner products of each query row.

    Components are ``floor(scale * x)``. ``is_query`` marks the rows that ask;
    every other row, and every other query, is a candidate.
    """
    rows = vectors.filter(finite(vec_col)).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"),
        F.size(vec_col).alias("dim"),
        F.transform(vec_col, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    n_shards = shard_count(rows, rows_per_shard)
    # Vectors of other lengths lack the terms beyond their end: all are padded to the longest.
    longest = rows.agg(F.max("dim")).first()[0] or 0
    padded = rows.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.col("dim")))) \
        .withColumn("dim", F.lit(longest))
    shards = padded.select("dim", F.pmod(F.xxhash64("row"), F.lit(n_shards)).cast("int").alias("shard"), "id", "row", "vec")
    queries = padded.filter("query").select("dim", "id", "row", "vec")

    def load(key, table):
        return Postings(table)

    def answer(index, batch):
        own, scores = batch.column("row").to_numpy(), index.scores(matrix(batch.column("vec"), np.int64))
        picks = []
        for q in range(len(own)):
            at = best_of(scores[q], k + 1)
            picks.append(at[index.rows[at] != own[q]][:k])
        who = np.repeat(np.arange(len(own)), [len(p) for p in picks])
        at = np.concatenate(picks)
        return pa.RecordBatch.from_arrays([pa.array(own[who]), batch.column("id").take(pa.array(who)),
                                           index.ids.take(pa.array(at)), pa.array(scores[who, at])], schema=SCHEMA)
    found = search(shards, queries, n_shards, load, answer, "query_row long, query_id long, vec_id long, score long")
    return merge_top(found, k, F.col("score").desc())
