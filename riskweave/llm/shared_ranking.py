"""Ranked lexical search of many items at once, with shared subexpressions evaluated once.

An item's score for a document is a sum over the item's terms, so items that
share terms share partial sums. The items are put into blocks of similar ones
(:func:`sharing_plan`); in a block the largest term set that two items, or sets
already found, have in common becomes a node of its own, and every member that
holds all of it refers to the node instead, until no three terms are shared.
That gives a DAG: an item is a few nodes and what terms it has alone.

The documents are cut into terms once; what they hold of the items' terms is
staged as postings. A task then takes some hundred documents at a time, scatters
the weighted postings into a dense table of terms by documents, materialises
every node of the DAG once as an array over these documents, and adds up each
item from nodes and own terms. It keeps each item's k best; a window merges the
tasks. The work is exhaustive: no document or term is left out.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII;
only A-Z are lower-cased. All but the logarithm is 64-bit integer arithmetic.

Items are taken in groups of at most about ``group_terms`` terms in all, each
group with its own pass over the documents, so what tasks and the driver hold
of the items stays bounded, however many there are.

Edge cases: null and empty texts have no terms; rows of one item id (also the
null id) are one item with all their terms; rows of one document id are
documents of their own; a null document id comes last among equal scores;
repeated terms of an item count once; texts of any length are cut in one piece
each; without documents or items there are no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import exclusive_sum, staged, text_column, text_slices

_BYTES = np.arange(256)
IS_TERM = ((_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
           | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, one after another, and where each text's terms start (with the total at the end)."""
    texts = texts.cast(pa.string())
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    held = IS_TERM[data]
    first = held.copy()
    first[1:] &= ~held[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    first[edges] = held[edges]  # a text's first character begins a term of its own
    starts = np.flatnonzero(first)
    compact = np.cumsum(held)
    offsets = np.append(compact[starts] - 1, compact[-1] if len(compact) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(LOWER[data[held]]))
    return words, np.searchsorted(starts, ends)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, terms) with the distinct terms of every item that has any, in order."""
    def cut(batches):
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, starts = terms_of(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("item_id").take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(starts)))),
                                                  words], names=["item_id", "term"])
    cells = items.select(F.col(id_col).alias("item_id"), text_column(text_col).alias("text"))
    kind = cells.schema["item_id"].dataType.simpleString()
    return (cells.mapInArrow(cut, f"item_id {kind}, term string").distinct()
            .groupBy("item_id").agg(F.array_sort(F.collect_list("term")).alias("terms")))


def share(sets: list[np.ndarray], n_terms: int, least: int = 3) -> list[tuple[np.ndarray, list[int]]]:
    """Own terms and nodes of every set, and then of every shared node.

    The largest intersection of two sets becomes a node; every set that holds
    all of it refers to the node. A node may be split by later nodes only.
    """
    held = np.zeros((len(sets), n_terms), np.float32)
    for k, terms in enumerate(sets):
        held[k, terms] = 1
    refers: list[list[int]] = [[] for _ in sets]
    common = held @ held.T
    np.fill_diagonal(common, 0)
    while len(common) > 1:
        a, b = divmod(int(common.argmax()), len(common))
        if common[a, b] < least:
            break
        both = held[a] * held[b]
        size = both.sum()
        users = np.flatnonzero(held @ both == size)
        node = len(held)
        held[users] -= both
        held = np.vstack([held, both])
        refers.append([])
        for u in users:
            refers[u].append(node)
        grown = np.zeros((node + 1, node + 1), np.float32)
        grown[:node, :node] = common
        changed = np.append(users, node)
        grown[changed] = held[changed] @ held.T
        grown[:, changed] = grown[changed].T
        np.fill_diagonal(grown, 0)
        common = grown
    return [(np.flatnonzero(row), nodes) for row, nodes in zip(held, refers)]


PLAN = "block long, step int, item_id {kind}, is_item boolean, terms array<string>, nodes array<int>"


def sharing_plan(items: DataFrame, block_items: int = 256) -> DataFrame:
    """The query-sharing DAG of items (item_id, terms), as one row for each node and item.

    ``nodes`` are steps of the same block; each is smaller than the step that
    refers to it, so steps in ascending order are an order of evaluation.
    Blocks hold at most ``block_items`` items, neighbours by the least hash of
    their terms, which two items share with the probability of their similarity.
    """
    def mine(batches):
        from pyspark import TaskContext
        task, block, waiting = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            waiting += zip(batch.column("item_id").to_pylist(), batch.column("terms").to_pylist())
            while len(waiting) >= block_items:
                yield planned((task << 32) + block, waiting[:block_items])
                waiting, block = waiting[block_items:], block + 1
        if waiting:
            yield planned((task << 32) + block, waiting)

    def planned(block, rows):
        vocabulary = sorted({t for _, terms in rows for t in terms})
        at = {t: k for k, t in enumerate(vocabulary)}
        sets = share([np.array([at[t] for t in terms], int) for _, terms in rows], len(vocabulary))
        last = len(sets) - 1  # later nodes never refer to earlier ones: steps count down
        order = range(last, -1, -1)
        return pa.RecordBatch.from_arrays([
            pa.array([block] * len(sets), pa.int64()), pa.array([last - k for k in order], pa.int32()),
            pa.array([rows[k][0] if k < len(rows) else None for k in order], type=arrow_id), pa.array([k < len(rows) for k in order]),
            pa.array([[vocabulary[t] for t in sets[k][0]] for k in order], pa.list_(pa.string())),
            pa.array([[last - n for n in sets[k][1]] for k in order], pa.list_(pa.int32()))],
            names=["block", "step", "item_id", "is_item", "terms", "nodes"])
    kind = items.schema["item_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_id = to_arrow_type(items.schema["item_id"].dataType)
    near = items.withColumn("least", F.array_min(F.transform("terms", lambda t: F.xxhash64(t))))
    return near.repartitionByRange("least").sortWithinPartitions("least").select("item_id", "terms").mapInArrow(mine, PLAN.format(kind=kind))


POSTINGS = "counts boolean, doc_id long, n long, terms array<int>, tf array<long>"


def postings(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with any term its number of terms, and which of the vocabulary it holds how often.

    A task adds one row with ``counts`` set: the vocabulary's terms and how many
    of the task's documents hold each.
    """
    known = pa.array(vocabulary, pa.string())

    def cut(batches):
        holders = np.zeros(len(known), np.int64)
        for batch in batches:
            for part in text_slices(batch, "text"):
                words, starts = terms_of(part.column("text"))
                coded = words.dictionary_encode()
                at = pc.index_in(coded.dictionary, known).fill_null(-1).to_numpy()
                term = at[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
                n = np.diff(starts)
                keep = term >= 0
                cells, tf = np.unique(np.repeat(np.arange(len(n)), n)[keep] * len(known) + term[keep], return_counts=True)
                row, term = np.divmod(cells, max(1, len(known)))
                holders += np.bincount(term, minlength=len(known))
                ends = pa.array(exclusive_sum(np.bincount(row, minlength=len(n))).astype(np.int32))
                out = pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(len(n), bool)), part.column("doc_id"), pa.array(n.astype(np.int64)),
                     pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))],
                    names=["counts", "doc_id", "n", "terms", "tf"])
                yield out.filter(pa.array(n > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array([True]), pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([np.flatnonzero(holders).astype(np.int32)], pa.list_(pa.int32())),
             pa.array([holders[holders > 0]], pa.list_(pa.int64()))], names=["counts", "doc_id", "n", "terms", "tf"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_column(text_col).alias("text"))
    return staged(rows.mapInArrow(cut, POSTINGS), "ranking-postings")


class Best:
    """The k best documents of every item so far; ties go to smaller ids, null ids last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in range(n_items)]
        self.least = np.zeros(n_items, np.int64)  # what a document must reach, over 0

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, lacks_id: np.ndarray) -> None:
        at = np.flatnonzero((scores >= self.least[item]) & (scores > 0))
        if not len(at):
            return
        score, doc, none = (np.concatenate([a, b[at]]) for a, b in zip(self.held[item], (scores, ids, lacks_id)))
        best = np.lexsort((doc, none, -score))[:self.k]
        self.held[item] = score[best], doc[best], none[best]
        if len(best) == self.k:
            self.least[item] = score[best[-1]]


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, group_terms: int = 1_000_000, block_items: int = 256,
           cells: int = 8_000_000) -> DataFrame:
    """item_id, rank, doc_id, score of every item's k best documents of score above 0.

    ``docs``: doc_id, text. ``items``: item_id, text. ``cells`` bounds the dense
    tables of a task (numbers of 8 bytes).
    """
    asked = staged(item_terms(items), "ranking-items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, -(-total // group_terms))
    found = None
    for g in range(groups):
        part = _ranked_group(docs, asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == g), k, block_items, cells)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _ranked_group(docs: DataFrame, items: DataFrame, k: int, block_items: int, cells: int) -> DataFrame:
    # At most about group_terms terms in all: the DAG, its vocabulary and the counts come to the driver and go to every task.
    plan = sharing_plan(items, block_items).collect()
    vocabulary = sorted({t for r in plan for t in r["terms"]})
    held = postings(docs, vocabulary)
    n_docs, n_terms = held.filter("not counts").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(held.filter("counts").select(F.explode(F.arrays_zip("terms", "tf")).alias("x")).groupBy("x.terms")
              .agg(F.sum("x.tf").alias("df")).collect())
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(vocabulary))], np.int64)
    at = {t: i for i, t in enumerate(vocabulary)}
    blocks: dict[int, list] = {}
    for r in sorted(plan, key=lambda r: (r["block"], r["step"])):
        blocks.setdefault(r["block"], []).append((r["is_item"], r["item_id"], np.array([at[t] for t in r["terms"]], int), np.array(r["nodes"], int)))
    dags = list(blocks.values())
    asked = [[item for own, item, _, _ in dag if own] for dag in dags]
    wide = len(vocabulary) + max(map(len, dags), default=0)
    from pyspark.sql.pandas.types import to_arrow_type
    kind = items.schema["item_id"].dataType
    arrow_id = to_arrow_type(kind)

    def score(batches: Iterator[pa.RecordBatch]):
        best = [Best(len(x), k) for x in asked]
        step = max(1, min(4096, cells // max(1, wide)))
        for batch in batches:
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                add(best, part)
        for names, tops in zip(asked, best):
            for name, (scores, ids, none) in zip(names, tops.held):
                if len(scores):
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(scores), arrow_id), pa.array(ids, mask=none), pa.array(scores)],
                                                     names=["item_id", "doc_id", "score"])

    def add(best, part):
        lists = part.column("terms")
        row = np.repeat(np.arange(part.num_rows), pc.list_value_length(lists).to_numpy())
        term, tf = lists.flatten().to_numpy(), part.column("tf").flatten().to_numpy()
        m = 10 + 90 * part.column("n").to_numpy() * n_docs // n_terms
        gains = np.zeros((len(vocabulary), part.num_rows), np.int64)
        gains[term, row] = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
        none = pc.is_null(part.column("doc_id")).to_numpy(zero_copy_only=False)
        ids = part.column("doc_id").fill_null(0).to_numpy()
        for dag, tops in zip(dags, best):
            sums = np.empty((len(dag), part.num_rows), np.int64)
            item = 0
            for s, (own, _, terms, nodes) in enumerate(dag):
                np.add(gains[terms].sum(axis=0), sums[nodes].sum(axis=0), out=sums[s])
                if own:
                    tops.add(item, sums[s], ids, none)
                    item += 1
    return (held.filter("not counts and size(terms) > 0").select("doc_id", "n", "terms", "tf")
            .mapInArrow(score, f"item_id {kind.simpleString()}, doc_id long, score long"))
