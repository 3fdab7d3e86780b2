"""Vectors in hash shards, and a set of queries run against every shard.

A shard holds a bounded number of rows. Each query goes to every shard, so
queries x shards rows are shuffled, never queries x rows; a task reads its
shard first and then streams the queries past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import shuffle_width


def finite(vector: str) -> Column:
    """Neither null nor holding a null or non-finite component."""
    ok = F.forall(F.col(vector), lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    return F.col(vector).isNotNull() & F.coalesce(ok, F.lit(False))


def shard_count(df: DataFrame, rows_per_shard: int, least_rows: int = 2048) -> int:
    """Shards of at most about ``rows_per_shard`` rows, and work for every task where rows are few."""
    n = df.count()
    return max(1, -(-n // rows_per_shard), min(shuffle_width(df.sparkSession), -(-n // least_rows)))


def matrix(column: pa.Array, dtype) -> np.ndarray:
    """A list column of equally long lists as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def runs_by(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Cut sorted batches where a key changes."""
    for b in batches:
        if not b.num_rows:
            continue
        values = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        change[0] = True
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        at = np.append(np.flatnonzero(change), b.num_rows)
        for a, z in zip(at, at[1:]):
            yield tuple(int(v[a]) for v in values), b.slice(int(a), int(z - a))


def per_shard(df: DataFrame, work: Callable, schema: str, keys=("dim", "shard")) -> DataFrame:
    """``work(key, table)`` once for every shard (rows in ``id, row`` order); yields record batches."""
    keys = list(keys)

    def run(batches):
        held, now = [], None
        for key, part in runs_by(batches, keys):
            if key != now and held:
                yield from work(now, pa.Table.from_batches(held))
                held = []
            now = key
            held.append(part)
        if held:
            yield from work(now, pa.Table.from_batches(held))
    return (df.repartition(*keys).sortWithinPartitions(*keys, F.col("id").asc_nulls_last(), "row").mapInArrow(run, schema))


def search(shards: DataFrame, queries: DataFrame, n_shards: int, load: Callable, answer: Callable,
           schema: str, block: int = 256) -> DataFrame:
    """Stream ``queries`` past every shard of their dimension.

    ``load(key, table)`` makes a shard's index; ``answer(index, batch)`` gives a
    batch of at most ``block`` queries its rows. Both frames have dim, id, row, vec.
    """
    asked = (queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
             .withColumn("asks", F.lit(1)))
    both = shards.withColumn("asks", F.lit(0)).unionByName(asked, allowMissingColumns=True)

    def run(batches):
        index, held, now = None, [], None
        for (*key, asks), part in runs_by(batches, ["dim", "shard", "asks"]):
            if tuple(key) != now:
                index, held, now = None, [], tuple(key)
            if not asks:
                held.append(part)
                continue
            if index is None:
                if not held:
                    continue  # no row of this dimension in this shard
                index, held = load(now, pa.Table.from_batches(held)), []
            for a in range(0, part.num_rows, block):
                yield answer(index, part.slice(a, block))
    return (both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "asks", F.col("id").asc_nulls_last(), "row")
            .mapInArrow(run, schema))


def merge_top(found: DataFrame, k: int, best: Column) -> DataFrame:
    """The k best of the rows that the shards found for a query, ranked from 1; ties to smaller ids."""
    order = Window.partitionBy("query_row").orderBy(best, F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
