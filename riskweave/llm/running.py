"""Running counts and sums in a total order, without a task that sees more than its range.

Rows are dealt into ranges of the order, each task runs over its range, and what
a key's rows gathered in the ranges before (a few numbers a range) is added
afterwards. So neither a key that holds most rows nor the order as a whole
meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskweave.llm.common import staged

NUMPY = {"add": np.add, "xor": np.bitwise_xor}


def _segments(values: np.ndarray, starts: np.ndarray, of: np.ndarray, op: np.ufunc, carry: int) -> np.ndarray:
    """Running ``op`` of values within segments; ``carry`` is what the first segment has so far."""
    run = op.accumulate(values)
    before = np.zeros(len(starts), np.int64)
    if op is np.add:
        before[1:] = run[starts[1:] - 1]
        before[0] = -carry
        return run - before[of]
    before[1:] = run[starts[1:] - 1]
    before[0] = carry
    return run ^ before[of]


def running(df: DataFrame, key: str | None, order: list[Column], add: tuple[str, ...] = (), xor: tuple[str, ...] = (),
            name: str = "running") -> DataFrame:
    """``df`` with ``nth`` (place within its key, from 1) and ``run_<c>`` (with its own value) of the columns named.

    ``order`` starts with the key; the key and the columns are longs without
    nulls. Without a key all rows are one run. The result is written once.
    """
    if key is not None:
        df = df.withColumn("run_key", F.col(key).cast("long"))
    else:
        df = df.withColumn("run_key", F.lit(0).cast("long"))
    values = [("nth", "add"), *((c, "add") for c in add), *((c, "xor") for c in xor)]
    names = ["nth", *(f"run_{c}" for c in (*add, *xor))]
    held = df.columns

    def scan(batches):
        last, have, line = None, [0] * len(values), 0
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column("run_key").to_numpy()
            change = np.append(True, keys[1:] != keys[:-1])
            starts, of = np.flatnonzero(change), np.cumsum(change) - 1
            if keys[0] != last:
                have = [0] * len(values)
            runs = []
            for (c, op), carry in zip(values, have):
                x = np.ones(len(keys), np.int64) if c == "nth" else b.column(c).to_numpy().astype(np.int64)
                runs.append(_segments(x, starts, of, NUMPY[op], carry))
            last, have = keys[-1], [int(r[-1]) for r in runs]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in held), b.column("part"), pa.array(line + np.arange(len(keys))),
                                              *map(pa.array, runs)], names=[*held, "part", "line", *names])
            line += len(keys)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id().cast("long"))
    kind = StructType([*ranged.schema.fields, *(StructField(n, LongType()) for n in ("line", *names))])
    rows = staged(ranged.mapInArrow(scan, kind), name)
    ends = F.struct("run_key", *names)
    ranges = rows.groupBy("part").agg(F.min_by("run_key", "line").alias("first"), F.max_by(ends, "line").alias("last")).orderBy("part").collect()
    carries, gone = [], None  # as many rows as there are ranges
    for r in ranges:
        now = [r["last"][n] for n in names]
        if gone is not None and gone[0] == r["first"]:
            carries.append((r["part"], r["first"], *gone[1]))
            if r["last"]["run_key"] == r["first"]:
                now = [a ^ b if op == "xor" else a + b for a, b, (_, op) in zip(gone[1], now, values)]
        gone = (r["last"]["run_key"], now)
    out = rows.drop("line")
    if carries:
        spark = df.sparkSession
        table = spark.createDataFrame(carries, "part long, run_key long, " + ", ".join(f"had_{n} long" for n in names))
        out = out.join(F.broadcast(table), ["part", "run_key"], "left")
        for n, (_, op) in zip(names, values):
            had = F.coalesce(f"had_{n}", F.lit(0).cast("long"))
            out = out.withColumn(n, F.col(n).bitwiseXOR(had) if op == "xor" else F.col(n) + had).drop(f"had_{n}")
    return out.drop("part", "run_key")
