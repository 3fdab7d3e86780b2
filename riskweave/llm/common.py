"""Small helpers shared by the operators: staged tables, batch slicing, partition counts."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import scratch_path


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read it back.

    Later steps read the written copy, so a lost executor never recomputes what
    lies before it, and values that depend on task layout are fixed once.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_if(df: DataFrame, most_rows: int = 500_000) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have few rows (of a few numbers each), else as it is."""
    return F.broadcast(df) if df.count() <= most_rows else df


def text_column(name: str = "text"):
    return F.coalesce(F.col(name), F.lit(""))


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of rows with about ``max_bytes`` of text (one row at least)."""
    if not batch.num_rows:
        return
    lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def release_memory() -> None:
    """Give freed memory of this worker back to the system: what earlier tasks, also of other steps, left to its allocators."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def exclusive_sum(values: np.ndarray) -> np.ndarray:
    """Starts of runs of the given lengths, with the total at the end."""
    out = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=out[1:])
    return out


def gather_runs(store: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``store[s:s+n]`` for each (s, n) without a Python loop."""
    begin = exclusive_sum(lengths)
    if not begin[-1]:
        return store[:0]
    return store[np.repeat(starts - begin[:-1], lengths) + np.arange(begin[-1])]
