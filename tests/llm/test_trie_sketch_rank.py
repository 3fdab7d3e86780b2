"""Prefix trie, fingerprints and ranked search against their SQL on tables full of edge cases, and their parts."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.llm import fingerprints as fp
from riskweave.llm.prefix_trie import contract, grafted, list_rank, numbered, trie
from riskweave.llm.queries import ORACLES
from riskweave.llm.running import running
from riskweave.llm.shared_ranking import item_terms, postings, ranked, share, sharing_plan, terms_of


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)) or x is pd.NA:
        return None
    return x if isinstance(x, str) else int(x) if float(x).is_integer() else float(x)  # pandas makes longs with nulls floats


def _rows(df, columns):
    return sorted(str(tuple(map(_plain, r))) for r in df[columns].astype(object).itertuples(index=False, name=None))


def _sql(name, **tables):
    con = duckdb.connect()
    for t, frame in tables.items():
        con.register(t, frame)
    return con.execute(ORACLES[name]).df()


# ---- running values

def test_running_over_ranges(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), i, int(a), int(b)) for i, (k, a, b) in enumerate(zip(
        np.where(rng.random(3000) < 0.5, 7, rng.integers(0, 30, 3000)), rng.integers(-5, 9, 3000), rng.integers(0, 2 ** 60, 3000)))]
    df = spark.createDataFrame(rows, "k long, t long, a long, b long").repartition(9)
    got = running(df, "k", [F.col("k"), F.col("t")], add=("a",), xor=("b",)).toPandas().sort_values(["k", "t"])
    want = pd.DataFrame(rows, columns=["k", "t", "a", "b"]).sort_values(["k", "t"])
    assert (got.nth.values == want.groupby("k").cumcount().values + 1).all()
    assert (got.run_a.values == want.groupby("k").a.cumsum().values).all()
    assert (got.run_b.values == want.groupby("k").b.transform(lambda x: np.bitwise_xor.accumulate(x.values)).values).all()
    whole = running(df, None, [F.col("t")], add=("a",)).toPandas().sort_values("t")
    assert (whole.nth.values == np.arange(1, 3001)).all() and (whole.run_a.values == want.sort_values("t").a.cumsum().values).all()
    assert running(df.limit(0), "k", [F.col("k")]).collect() == []


# ---- prefix trie

TURNS = [(0, 0, "user", "hello"), (0, 1, "bot", "hi 😀"), (0, 2, None, None), (1, 0, "user", "hello"), (1, 1, "bot", "hi 😀"),
         (2, 0, "user", "hello"), (2, 0, "user", "hello"), (2, 0, "bot", "tie"), (3, None, "user", "first"), (3, None, "user", "also"), (3, 1, "", ""),
         (4, 0, "user", "y" * 40_000), (4, 1, "a", "bc"), (5, 1, "ab", "c"), (5, 0, "user", "hello"), (None, 0, "user", "lost"),
         (250, 0, "x", "no base"), (251, 0, "x", "no base"), (252, 0, "x", "no base"), (-7, 0, "user", "hello"), (-107, 0, "user", "hello"),
         *((c, t, "user", f"turn {t}") for c in range(300, 340) for t in range(4)), *((900, t, "user", str(t % 3)) for t in range(300))]
KIND = "conv_id long, turn long, role string, text string"


def test_trie_against_sql(spark):
    turns = spark.createDataFrame(TURNS, KIND).selectExpr("*", "1 as depth", "'x' as sha", "2 as nth", "0 as part")
    want = _sql("op11_prefix_trie", conversations=pd.DataFrame(TURNS, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}))
    for few in (4096, 100):  # one task, and rulers
        got = trie(*grafted(numbered(turns)), few=few).toPandas()
        assert _rows(got, sorted(want.columns)) == _rows(want, sorted(want.columns))
    assert got.n_convs.max() == got[got.depth == 0].n_convs.iloc[0] == len({r[0] for r in TURNS} - {None})
    assert trie(*grafted(numbered(turns.limit(0)))).collect() == []


def test_list_rank_and_paths(spark):
    rng = np.random.default_rng(5)
    order = rng.permutation(2000) * 3
    links = pd.DataFrame({"id": order, "n": rng.integers(1, 9, 2000)})
    left = dict(zip(order, links.n[::-1].cumsum()[::-1]))
    df = spark.createDataFrame(list(zip(order.tolist(), [*order[1:].tolist(), None], links.n.tolist())), "id long, to long, n long")
    for few in (10_000, 40):  # one task, and two levels of rulers
        assert {r["id"]: r["left"] for r in list_rank(df, few=few, one_in=6).collect()} == left
    some = rng.choice(2000, 800, replace=False)
    arc, to = order[some], np.append(order, -1)[some + 1]
    head, before = contract(arc, to)
    here = {int(a) for a in arc}
    at = {int(a): i for i, a in enumerate(order)}
    for a, h, b in zip(arc, arc[head], before):
        assert at[int(a)] - at[int(h)] == b and all(int(order[i]) in here for i in range(at[int(h)], at[int(a)]))
        assert at[int(h)] == 0 or int(order[at[int(h)] - 1]) not in here


# ---- fingerprints

DOCS = [(3, "One two three four five six seven eight nine ten. " * 3), (1, None), (2, ""), (7, "Ein kurzer Text"), (7, "tie of an id"), (7, "tie of an id"),
        (9, "äöü 😀 " * 30), (12, " \t\n "), (None, "without an id but with words enough to count"), (20, "w " * 400), (21, "x"), (22, " ".join(map(str, range(600)))),
        (40, "abcdefgh"), (41, "one two three four five six seven eight nine ten. " * 3)]


def test_fingerprints_against_sql(spark):
    import __spark_entry__ as entry
    docs = pd.DataFrame(DOCS, columns=["doc_id", "text"]).astype({"doc_id": "Int64"})
    want = _sql("op12_fingerprints", documents=docs)
    import tempfile
    with tempfile.TemporaryDirectory() as folder:
        docs.assign(block=1, sha="s", copy=2, id=5).to_parquet(f"{folder}/documents.parquet")
        got = entry.queries()["op12_fingerprints"](spark, folder).toPandas()
        assert _rows(got, sorted(want.columns)) == _rows(want, sorted(want.columns))
    few = fp.fingerprints(spark.createDataFrame(DOCS, "doc_id long, text string"), 16, rows_per_block=1).toPandas()
    assert len(few) == len(DOCS) and few.n_chars.sum() == sum(len(t or "") for _, t in DOCS)
    for r in few.itertuples():  # the edited text is as long, unless the next one is too short
        assert len(r.edited) <= r.n_chars and r.edited.startswith(r.text[:r.n_chars - r.n_chars // 4])
    assert fp.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    alone = fp.fingerprints(spark.createDataFrame([(5, "only one here")], "doc_id long, text string")).collect()
    assert alone[0]["edited"] == "only one h" + "onl" and alone[0]["next_sketch"] == alone[0]["sketch"]


def test_sketches_merge_and_estimate(spark):
    k = 128
    texts = [" ".join(f"w{i}" for i in range(a, b)) for a, b in ((0, 3000), (1000, 4000), (0, 12_000), (500, 600))]
    df = fp.sketched(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text", "s", k)
    s = {r["id"]: r["s"] for r in df.collect()}
    pair = lambda a, b, f: spark.createDataFrame([(s[a], s[b])], "a array<string>, b array<string>").select(
        f(F.col("a"), F.col("b"), k).alias("x")).first()["x"]
    assert abs(pair(0, 1, fp.resemblance) - 2 / 4) < 0.15 and abs(pair(0, 2, fp.containment) - 1) < 0.01
    assert abs(pair(2, 0, fp.containment) - 0.25) < 0.15 and pair(3, 0, fp.containment) == 1
    assert abs(df.filter("id = 2").select(fp.distinct_shingles(F.col("s"), k).alias("n")).first()["n"] / 12_000 - 1) < 0.3
    assert df.filter("id = 3").select(fp.distinct_shingles(F.col("s"), k).alias("n")).first()["n"] == 96
    # Parts that overlap by four words merge into the sketch of the whole, in groups of any size, null and empty ones too.
    words = texts[2].split(" ")
    parts = [("big", " ".join(words[a:a + 1004])) for a in range(0, 12_000, 1000)] + [("none", ""), (None, "a b")]
    held = fp.sketched(spark.createDataFrame(parts, "g string, text string"), "text", "sketch", k)
    got = {r["g"]: r["sketch"] for r in fp.merged(held, ["g"], k).collect()}
    assert got["big"] == s[2] and got["none"] == [] and len(got[None]) == 1


# ---- ranked search

ITEMS = [(1, "the cat and the dog and the bird"), (2, "The cat and the dog and a fish"), (3, "A cat and a dog and a bird"), (4, None), (5, "..."), (6, "ünïcode 😀 x9"),
         (6, "more of six"), (None, "cat"), (7, "zzz unseen")]


def test_ranking_against_sql(spark):
    rng = np.random.default_rng(2)
    vocabulary = "the cat and dog bird fish a x9 ünïcode 😀 more of six other words CAT Dog".split()
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 30)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "!?"), (503, docs[5][1]), (503, docs[5][1]), (None, docs[5][1]), (504, "cat," * 20_000), (505, "ÄÖÜ İ cat\x00dog")]
    items = pd.DataFrame(ITEMS, columns=["item_id", "text"]).astype({"item_id": "Int64"})
    want = _sql("op13_shared_ranking", documents=pd.DataFrame(docs, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}), benchmark=items)
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "'t' as term", "0 as score").repartition(5)
    asked = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "2 as block", "3 as terms")
    for options in ({}, {"group_terms": 8, "block_items": 2, "cells": 100}):
        got = ranked(table, asked, 10, **options).toPandas()
        assert _rows(got, sorted(want.columns)) == _rows(want, sorted(want.columns))
    assert ranked(table.limit(0), asked).collect() == [] and ranked(table, asked.limit(0)).collect() == []


def test_shared_sets_give_back_the_items(spark):
    rng = np.random.default_rng(4)
    core = rng.choice(200, 25, replace=False)
    sets = [np.unique(np.concatenate([core[:rng.integers(5, 25)], rng.choice(200, 12)])) for _ in range(60)]
    nodes = share(sets, 200)
    whole = {}
    for k in range(len(nodes) - 1, -1, -1):
        own, refers = nodes[k]
        parts = [set(own.tolist()), *(whole[n] for n in refers)]
        whole[k] = set().union(*parts)
        assert sum(map(len, parts)) == len(whole[k])  # no term is added twice
    assert all(whole[k] == set(s.tolist()) for k, s in enumerate(sets))
    work = sum(len(a) + len(b) for a, b in nodes)
    assert len(nodes) > len(sets) and work < 0.7 * sum(map(len, sets))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = sharing_plan(item_terms(items)).collect()
    assert any(not r["is_item"] for r in plan) and all(n < r["step"] for r in plan for n in r["nodes"])


def test_terms_and_counts(spark):
    import pyarrow as pa
    words, starts = terms_of(pa.array(["x", "Ab_c é9", "", "9", "\x00--", "ß"]).slice(1))
    assert words.to_pylist() == ["ab", "c", "é9", "9", "ß"] and starts.tolist() == [0, 3, 3, 4, 4, 5]
    docs = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, None)], "doc_id long, text string").repartition(3)
    held = postings(docs, ["a", "b", "z"])
    assert {(r["doc_id"], r["n"], tuple(r["terms"]), tuple(r["tf"])) for r in held.filter("not counts").collect()} == {(1, 3, (0, 1), (2, 1)), (2, 1, (1,), (1,))}
    counts = held.filter("counts").selectExpr("explode(arrays_zip(terms, tf)) as x").groupBy("x.terms").agg(F.sum("x.tf")).collect()
    assert dict(map(tuple, counts)) == {0: 1, 1: 2}


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_fingerprints", "op13_shared_ranking"])
def test_queries_are_registered(name):
    import __spark_entry__ as entry
    assert name in entry.queries() and name in entry.oracle_sql()
