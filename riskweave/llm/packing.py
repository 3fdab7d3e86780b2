"""Sequence packing as a cutting-stock problem, solved by column generation.

Documents are cut at every ``capacity`` ids; what is left is a piece of at most
``capacity`` ids. Piece lengths are counted in classes of ``grain`` ids (a
bounded histogram, the only thing that reaches the driver). A linear program
over cutting patterns of the histogram is solved by the simplex method, with a
knapsack dynamic program that prices new patterns from the duals; pattern
counts are rounded down and the few pieces left are placed first-fit
decreasing. Spark ranks the pieces of a class (counts per bucket of rows, then
ranks inside a bucket, so a class with a third of all rows is spread) and deals
them to the slots of the patterns.

Edge cases: a special string of the vocabulary in a text has its own id, as in
the library; a null or empty text is its end id alone; repeated rows are
documents of their own; an empty table gives no pieces; ids in the result's
sequences number from 0 without gaps.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.chunks import WordLevelEncoder
from riskweave.llm.common import exclusive_sum, release_memory, shuffle_width, staged, text_column, text_slices
from riskweave.llm.direct_codes import _encoder, with_end


def price(values: np.ndarray, weights: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the best total value and how often each item is taken."""
    by_weight = np.full(capacity + 1, -np.inf)
    by_weight[weights] = values
    backwards = np.zeros(capacity + 1)  # best[c] is held at capacity - c, so that best[c - w] runs forward in w
    taken = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        with_item = backwards[capacity - c + 1:] + by_weight[1:c + 1]
        k = int(with_item.argmax())
        most, without = with_item[k], backwards[capacity - c + 1]
        if most > without + 1e-12:
            backwards[capacity - c], taken[c] = most, k + 1
        else:
            backwards[capacity - c] = without
    counts, c = np.zeros(capacity + 1, np.int64), capacity
    while c > 0:
        if taken[c]:
            counts[taken[c]] += 1
        c -= max(1, int(taken[c]))
    return float(backwards[0]), counts[weights]


def solve_patterns(weights: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3,
                   max_columns: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """Linear program min sum(x), patterns @ x = demand, by column generation.

    Returns the basis (one pattern a column) and its levels. It ends once the
    dual bound is within ``gap`` of the objective, or after ``max_columns``
    columns; any basis is a valid packing.
    """
    n = len(weights)
    each = capacity // weights
    basis = np.diag(each).astype(float)
    inverse = np.diag(1.0 / each)
    x = demand / each
    for step in range(max_columns):
        duals = inverse.sum(axis=0)
        value, column = price(np.maximum(duals, 0), weights, capacity)
        if value <= 1 + 1e-9 or duals @ demand / value >= x.sum() - max(gap * x.sum(), 0.5):
            break
        move = inverse @ column
        up = move > 1e-9
        if not up.any():
            break
        ratio = np.full(n, np.inf)
        ratio[up] = x[up] / move[up]
        out = int(np.argmin(ratio))
        x = np.maximum(x - ratio[out] * move, 0)
        x[out] = ratio[out]
        row = inverse[out] / move[out]
        inverse -= np.outer(move, row)
        inverse[out] = row
        basis[:, out] = column
        if step % 200 == 199:  # rounding errors of the updates
            inverse = np.linalg.inv(basis)
            x = np.maximum(inverse @ demand, 0)
    return basis.astype(np.int64), x


def plan_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, class -> pieces in each) that use up the histogram exactly."""
    classes = np.array(sorted(k for k, n in histogram.items() if n), dtype=np.int64)
    if not len(classes):
        return []
    demand = np.array([histogram[int(k)] for k in classes], dtype=np.int64)
    basis, x = solve_patterns(classes, demand, capacity)
    left, plan = demand.copy(), []
    for p in np.argsort(-x, kind="stable"):
        used = basis[:, p]
        on = used > 0
        n = min(int(x[p] + 1e-6), int((left[on] // used[on]).min())) if on.any() else 0
        if n > 0:
            left -= n * used
            plan.append((n, {int(classes[i]): int(used[i]) for i in np.flatnonzero(on)}))
    bins: list[tuple[int, dict[int, int]]] = []  # what rounding left, largest first into the first bin that has room
    for i in range(len(classes) - 1, -1, -1):
        w, todo = int(classes[i]), int(left[i])
        for k, (room, held) in enumerate(bins):
            put = min(todo, room // w)
            if put:
                held[w] = held.get(w, 0) + put
                bins[k] = (room - put * w, held)
                todo -= put
        while todo:
            put = min(todo, capacity // w)
            bins.append((capacity - put * w, {w: put}))
            todo -= put
    return plan + [(1, held) for _, held in bins]


@dataclass
class Packing:
    """``pieces``: row, doc_id, start, length, doc_tokens, ids (little-endian uint32 bytes);
    ``placement``: row, sequence_id, offset."""

    pieces: DataFrame
    placement: DataFrame

    def sequences(self) -> DataFrame:
        """The packed sequences: sequence_id, length, ids (bytes, not padded)."""
        both = self.pieces.join(self.placement, "row")
        parts = both.groupBy("sequence_id").agg(
            F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        ids = F.aggregate("parts", F.lit(b"").cast("binary"), lambda out, p: F.concat(out, p["ids"]))
        return parts.select("sequence_id", "length", ids.alias("ids"))


def tokenise_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Encode whole texts and cut them at every ``capacity`` ids; written once, read by later steps."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))

    def run(batches):
        release_memory()
        encoder = _encoder(vocabulary, WordLevelEncoder)
        for batch in batches:
            for rows in text_slices(batch, "text"):
                ids, offsets = with_end(*encoder.encode(rows.column("text")), end_id)
                lengths = np.diff(offsets)
                pieces = -(-lengths // capacity)
                doc = np.repeat(np.arange(len(lengths)), pieces)
                start = (np.arange(len(doc)) - exclusive_sum(pieces)[doc]) * capacity
                length = np.minimum(capacity, lengths[doc] - start)
                ends = exclusive_sum(length * 4)
                held = pa.Array.from_buffers(pa.large_binary(), len(doc), [
                    None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                     pa.array(lengths[doc]), held], names=["doc_id", "start", "length", "doc_tokens", "ids"])
        release_memory()
    cut = source.mapInArrow(run, "doc_id long, start long, length long, doc_tokens long, ids binary")
    # Every piece gets a number of its own, fixed by the written copy (document ids may repeat).
    return staged(cut.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 4096, grain: int = 8) -> Packing:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` ids."""
    spark = docs.sparkSession
    pieces = tokenise_pieces(docs, vocabulary, end_id, capacity)
    width = capacity // grain
    sized = pieces.select("row", "length",
                          F.ceil(F.col("length") / grain).cast("int").alias("size"),
                          F.pmod(F.xxhash64("row"), F.lit(4 * shuffle_width(spark))).cast("int").alias("bucket"))
    counts = staged(sized.groupBy("bucket", "size").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    plan = plan_patterns(histogram, width)
    slots, first, used = [], 0, {}
    for n, held in plan:
        at = 0
        for size, copies in sorted(held.items(), reverse=True):
            lo = used.get(size, 0)
            used[size] = lo + n * copies
            slots.append((size, lo, used[size], copies, first, at))
            at += copies
        first += n
    # At most as many rows as classes x patterns in the basis: a bound that does not grow with the input.
    table = F.broadcast(spark.createDataFrame(slots, "size int, lo long, hi long, copies long, first long, slot long"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = (sized.withColumn("inside", F.row_number().over(
                  Window.partitionBy("bucket", "size").orderBy("row")) - 1)
              .join(before.select("bucket", "size", "before"), ["bucket", "size"])
              .withColumn("rank", F.col("before") + F.col("inside")))
    dealt = ranked.join(table, (ranked["size"] == table["size"]) & (F.col("rank") >= F.col("lo"))
                        & (F.col("rank") < F.col("hi")))
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placement = (dealt.select("row", "length",
                              (F.col("first") + F.floor((F.col("rank") - F.col("lo")) / F.col("copies"))).alias("sequence_id"),
                              (F.col("slot") + (F.col("rank") - F.col("lo")) % F.col("copies")).alias("place"))
                 .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))
                 .select("row", "sequence_id", "offset"))
    return Packing(pieces, placement)
