import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm.exact_topk import best_of, exact_topk
from riskweave.llm.graph_search import beam_search, build_graph, nearest, robust_prune

SCHEMA = "vec_id long, embedding array<float>, score string, row int"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)], "x", 1) for i in range(300)]
    rows += [(i, rows[7][1], "x", 1) for i in range(1000, 1040)]  # one vector very often
    rows += [(100, rows[100][1], "x", 1)]  # a repeated row
    rows += [(400, None, None, None), (500, [0.0] * 6, None, None), (600, [float("nan")] + [1.0] * 5, None, None),
             (700, [None] + [1.0] * 5, None, None), (800, [float("inf")] + [1.0] * 5, None, None), (None, rows[3][1], None, None),
             (900, [1.0, 2.0], None, None), (901, [1.0, 2.5], None, None)]
    return rows


def _valid(rows, zero):
    out = [(i, np.array(v, dtype=float)) for i, v, *_ in rows
           if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    return [x for x in out if zero or x[1].any()]


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_nearest_against_brute_force(spark, vectors):
    got = _found(nearest(spark.createDataFrame(vectors, SCHEMA), 10, F.col("vec_id") % 100 == 0, rows_per_shard=150))
    rows = _valid(vectors, zero=False)
    hits = total = 0
    for i, v in rows:
        if i is None or i % 100 or i == 100:
            continue
        others = [(float(np.sqrt(((w - v) ** 2).sum())), j is None, j) for j, w in rows if j != i and len(w) == len(v)]
        want = [(d, j) for d, _, j in sorted(others, key=lambda o: (o[0], o[1], o[2] or 0))[:10]]
        hits += len({j for _, j in want} & {j for _, j, _ in got.get(i, [])})
        total += len(want)
        assert len(got.get(i, [])) == len(want)
        assert [r for r, _, _ in got[i]] == list(range(1, len(want) + 1))
    assert hits >= 0.98 * total
    # The repeated row is a candidate of the other, at distance 0.
    assert sum(j == 100 and s == 0 for _, j, s in got[100]) == 2 and len(got[100]) == 20
    assert _found(nearest(spark.createDataFrame([], SCHEMA), 10, F.col("vec_id") % 100 == 0)) == {}


def test_topk_against_brute_force(spark, vectors):
    got = _found(exact_topk(spark.createDataFrame(vectors, SCHEMA), 10, F.col("vec_id") % 100 == 0, rows_per_shard=100))
    rows = [(i, np.floor(1024 * v).astype(int)) for i, v in _valid(vectors, zero=True)]
    dot = lambda a, b: int(a[:min(len(a), len(b))] @ b[:min(len(a), len(b))])
    for i, v in rows:
        if i is None or i % 100 or i == 100:
            continue
        others = sorted(((-dot(v, w), j is None, j or 0, j) for j, w in rows if j != i))[:10]
        assert got[i] == [(k, j, -s) for k, (s, _, _, j) in enumerate(others, 1)]
    assert len(got[100]) == 20
    assert _found(exact_topk(spark.createDataFrame([], SCHEMA), 10, F.col("vec_id") % 100 == 0)) == {}


def test_huge_components_do_not_wrap(spark):
    rows = [(0, [1e30, 1.0], "", 0), (1, [1e30, 1.0], "", 0), (2, [-1e30, 1.0], "", 0)]
    got = _found(exact_topk(spark.createDataFrame(rows, SCHEMA), 10, F.col("vec_id") == 0))
    assert [(j, s > 0) for _, j, s in got[0]] == [(1, True), (2, False)]


def test_best_of_ties():
    assert best_of(np.array([5, 9, 9, 1, 9]), 2).tolist() == [1, 2]
    assert best_of(np.array([5, 9]), 5).tolist() == [1, 0]
    assert best_of(np.array([], dtype=np.int64), 5).tolist() == []


def test_pruning_keeps_near_and_diverse_edges():
    vectors = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 0]], dtype=np.float32)
    edges = robust_prune(vectors, np.array([0]), np.array([[1, 2, 3, 4, -1, 0]]), degree=4, alpha=1.2)
    assert edges[0].tolist() == [1, 3, -1, -1]  # 2 and 4 lie behind 1


@pytest.mark.parametrize("n", [1, 2, 40, 1500])
def test_beam_finds_itself(n):
    vectors = np.random.default_rng(4).normal(size=(n, 8)).astype(np.float32)
    graph, entry = build_graph(vectors, 0)
    ids, far, _ = beam_search(vectors, graph, entry, vectors, 32)
    assert (ids[:, 0] == np.arange(n)).mean() >= 0.99 and (graph >= 0).sum(axis=1).max() <= 32
