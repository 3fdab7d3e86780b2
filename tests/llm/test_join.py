import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm.components import components
from riskweave.llm.ngram_join import near_duplicates, shared_counts, shingle_sets, spanning


def _sets(text):
    w = [x for x in re.split(r"[ \t\n\v\f\r]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute(rows, similarity=0.8):
    sets = [_sets(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and (sets[i] == sets[j] or (
        sets[i] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9))] for i in range(n)]
    label = list(range(n))
    for _ in range(n):
        label = [min([label[i]] + [label[j] for j in linked[i]]) for i in range(n)]
    least = {}
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        least[label[i]] = min(ids, default=None)
    return sorted(((rows[i][0], least[label[i]], len(linked[i])) for i in range(n)), key=str), len(set(label))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    out = []
    base = [rng.choice(words) for _ in range(120)]
    for k in range(90):  # one large group of near copies
        text = list(base)
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    passage = " ".join(rng.choice(words) for _ in range(40))  # a passage that many documents share
    for _ in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(20, 200)))
        out += [text + " " + passage if rng.random() < 0.5 else text]
    for _ in range(15):
        t = rng.choice(out[90:]).split()
        t[rng.randrange(len(t))] = "changed"
        out.append(" ".join(t))
    out += ["The same copy of a text here"] * 30 + ["the SAME copy\tof a text\nhere", "", None, "  \n ", "two words", "two words", "one"]
    out.append(" ".join(rng.choice(words) for _ in range(20_000)))
    ids = list(range(len(out)))
    ids[95] = ids[140] = None
    ids[150] = 149
    return list(zip(ids, out))


@pytest.mark.parametrize("limit,levels,block", [(64, 6, 512), (4, 1, 16), (8, 0, 32)])
def test_join_against_brute_force(spark, rows, limit, levels, block):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as row", "'x' as label", "2 as cid")
    found = near_duplicates(docs, limit=limit, levels=levels, block=block).collect()
    want, classes = _brute(rows)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found), key=str) == want
    assert sum(r["first"] for r in found) == classes


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (None, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 20: 20}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_kernels():
    import pyarrow as pa
    flat, offsets = shingle_sets(pa.array(["a b c d e f", "A b  c\td e f", "a b", "", "a b c d e f"]))
    sets = [flat[x:y].tolist() for x, y in zip(offsets, offsets[1:])]
    assert [len(s) for s in sets] == [2, 2, 1, 0, 2] and sets[0] == sets[1] == sets[4]
    rng = np.random.default_rng(6)
    many = [np.unique(rng.integers(0, 300, rng.integers(0, 80)).astype(np.uint64)) for _ in range(30)]
    assert (shared_counts(many, many) == [[len(np.intersect1d(x, y)) for y in many] for x in many]).all()
    links = np.zeros((6, 6), bool)
    for a, b in ((0, 3), (3, 5), (1, 4)):
        links[a, b] = links[b, a] = True
    assert spanning(links).tolist() == [0, 1, 2, 0, 1, 0]


@pytest.mark.parametrize("name", ["op2_ngram_join", "op4_exact_topk", "op5_chat_rotation", "op9_license_scan"])
def test_queries_match_their_sql(spark, name):
    from riskweave.llm.queries import ORACLES, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns and len(got) == len(want)
    key = lambda d: sorted(map(str, d[columns].astype(object).where(d[columns].notna(), None).itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_recall_after_many_splits(spark):
    """Pairs whose tokens are all common: buckets of a quarter of the classes are split three times or more."""
    from riskweave.llm import ngram_join
    rng = np.random.default_rng(4)
    pairs = 1500
    one = rng.integers(0, 4, (pairs, 64)).astype(np.uint32)
    two = np.where(rng.random(one.shape) < 0.8, one, (one + rng.integers(1, 4, one.shape)) % 4).astype(np.uint32)
    classes = [(2 * k + j, bytearray(sig[k].tobytes())) for k in range(pairs) for j, sig in enumerate((one, two))]
    frame = spark.createDataFrame(classes, "cid long, sig binary").localCheckpoint()
    links = ngram_join.candidate_links(frame, 0.8, 0.9999, limit=2, levels=6, slack=0.25)
    label = {r["node"]: r["label"] for r in components(links).collect()}
    lost = sum((one[k] == two[k]).sum() >= 35 and label.get(2 * k, -1) != label.get(2 * k + 1, -2) for k in range(pairs))
    assert lost <= 1
    chance = (1 - 0.9999) / 2
    assert ngram_join.missed(0.8, 13, 6, ngram_join.children_needed(0.8, 13, 6, chance)) <= chance
    assert 0.008 < ngram_join.missed(0.8, 13, 6, 1.25)
    assert ngram_join.missed(0.8, 13, 0, 1.0) == pytest.approx(0.2 ** 13)


def test_doubtful_classes_meet_the_settled_ones(spark):
    """A class that agrees enough with a settled one but is not linked to the settled one's pivot."""
    from riskweave.llm import ngram_join
    order = np.random.default_rng(20).permutation(64)  # the first 13 are the positions of level 0
    base = np.arange(64, dtype=np.uint32)
    settled, far = base.copy(), base.copy()
    settled[order[52:]] += 1000  # 52 of 64 with the pivots
    far[order[27:52]] += 2000  # 27 with the pivots, 39 with the settled one
    far[order[52:]] += 1000
    others = [np.where(np.isin(base, order[:13]), base, base + 10_000 * (k + 1)).astype(np.uint32) for k in range(20)]
    sigs = [base] * 60 + [settled, far, *others]
    frame = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sigs)], "cid long, sig binary").localCheckpoint()
    links = ngram_join.candidate_links(frame, 0.8, 0.9999, limit=1, levels=6, slack=0.25)
    label = {r["node"]: r["label"] for r in components(links).collect()}
    assert label[60] == label[61]


def test_joined_classes_ask_each_other_no_more(spark, monkeypatch):
    """One group of near copies that no pivot settles, and pairs beside it that share its buckets: no split multiplies the group."""
    from riskweave.llm import ngram_join
    rng, n = np.random.default_rng(3), 300
    base = np.arange(64, dtype=np.uint32)
    group = np.where(rng.random((n, 64)) < 0.8, base, rng.integers(10 ** 6, 10 ** 9, (n, 64))).astype(np.uint32)
    one = np.where(rng.random((5, 64)) < 0.3, base, rng.integers(10 ** 6, 10 ** 9, (5, 64))).astype(np.uint32)
    two = one.copy()
    two[:, :8] = 7
    sigs = [*group, *(s for pair in zip(one, two) for s in pair)]
    frame = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sigs)], "cid long, sig binary").localCheckpoint()
    rows, kept = {}, ngram_join.staged

    def counted(df, name):
        out = kept(df, name)
        rows[name] = out.count()
        return out
    monkeypatch.setattr(ngram_join, "staged", counted)
    links = ngram_join.candidate_links(frame, 0.8, 0.9999, limit=4, levels=6, slack=0.25)
    label = {r["node"]: r["label"] for r in components(links).collect()}
    assert len({label[k] for k in range(n)}) == 1
    assert all(label[n + 2 * k] == label[n + 2 * k + 1] for k in range(5))
    assert sum(v for k, v in rows.items() if k.startswith("join-paths")) <= 13 * len(sigs)


def test_no_plan_spans_the_levels(spark, monkeypatch):
    """Every level writes its links; a plan that holds all levels grows the driver."""
    from riskweave.llm import ngram_join
    rng, n = np.random.default_rng(11), 400
    one = rng.integers(0, 4, (n, 64)).astype(np.uint32)
    frame = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(one)], "cid long, sig binary").localCheckpoint()
    joins, kept = {}, ngram_join.staged

    def counted(df, name):
        joins[name] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return kept(df, name)
    monkeypatch.setattr(ngram_join, "staged", counted)
    links = ngram_join.candidate_links(frame, 0.8, 0.9999, limit=1, levels=3, slack=0.25)
    assert sum(name.startswith("join-judged") for name in joins) >= 3
    assert max(joins.values()) <= 16
    assert "Join " not in links._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_join_a_bucket_s_rows_once(spark, monkeypatch):
    """The rows of large buckets are joined to what is known of their bucket once, not once for every side that meets."""
    from riskweave.llm import ngram_join
    rng, n = np.random.default_rng(12), 300
    base = np.arange(64, dtype=np.uint32)
    near = np.where(rng.random((n, 64)) < 0.8, base, rng.integers(10 ** 6, 10 ** 9, (n, 64))).astype(np.uint32)
    alike = np.where(rng.random((n, 64)) < 0.42, base, rng.integers(10 ** 6, 10 ** 9, (n, 64))).astype(np.uint32)  # a passage in common
    twins = alike[:20].copy()
    twins[:, :10] = 7
    sigs = [*near, *alike, *twins]
    frame = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sigs)], "cid long, sig binary").localCheckpoint()
    plans, kept = {}, ngram_join.staged

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return kept(df, name)
    monkeypatch.setattr(ngram_join, "staged", seen)
    links = ngram_join.candidate_links(frame, 0.8, 0.9999, limit=8, levels=6, slack=0.25)
    label = {r["node"]: r["label"] for r in components(links).collect()}
    assert len({label[k] for k in range(n)}) == 1
    assert all(label[n + k] == label[2 * n + k] for k in range(20))
    met = [plan for name, plan in plans.items() if name.startswith("join-met")]
    assert met and all(plan.count("Join Inner") == 2 for plan in met)  # with the bucket, with the signatures


def test_only_classes_apart_are_compared(spark):
    """Blocks of a bucket: what is joined asks itself no more, and the doubtful ask the settled ones alone."""
    from riskweave.llm import ngram_join
    limit, n = 1, 2000
    kinds = [("few", 0, n, False, False), ("few", 1, 4, True, False), ("many", 5, 50, True, False), ("many", 6, n, False, True)]
    judged = spark.createDataFrame([(node, 10_000 * k + c, label, settled, doubtful) for k, (node, label, rows, settled, doubtful) in enumerate(kinds)
                                    for c in range(rows)], "name string, cid long, label long, settled boolean, doubtful boolean")
    judged = judged.selectExpr("xxhash64(name) as node", "cid", "label", "settled", "doubtful", "doubtful or not settled as open")
    parts = judged.groupBy("node", "label").agg(*(F.expr(x) for x in (
        "count(*) as n", "count_if(open) as open", "count_if(settled) as settled", "count_if(doubtful) as doubtful")))
    parts = parts.groupBy("node").agg(*(F.expr(x) for x in (
        "max_by(struct(label, open), n) as main", "sum(n) - max(n) as others", "sum(n) as n", "sum(open) as open",
        "sum(settled) as settled", "sum(doubtful) as doubtful")))
    blocks = {r["few"]: r.asDict() for r in ngram_join._block_counts(parts, limit, False).collect()}
    size = 8 * limit
    assert (blocks[True]["asks"], blocks[True]["asks_in"], blocks[True]["told_in"]) == (0, n // size, 1)
    assert (blocks[False]["asks"], blocks[False]["told"]) == (n // size, -(-50 // size))
    assert ngram_join._block_counts(parts, limit, True).filter("not few").first()["told"] == -(-(n + 50) // size)


def test_forest_joins_the_same_nodes(spark):
    """Every class of a group is linked to many pivots of it; a batch keeps a link for each node but one."""
    import pyarrow as pa
    from riskweave.llm.ngram_join import forest
    links = [(p, c) for c in range(100, 160) for p in range(20)] + [(500, 501), (501, 502), (502, 500), (700, 600)]
    batch = pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["a", "b"])
    kept = [(r["a"], r["b"]) for r in next(forest([batch])).to_pylist()]
    assert len(kept) == 79 + 2 + 1
    label = {r["node"]: r["label"] for r in components(spark.createDataFrame(kept, "a long, b long")).collect()}
    assert label == {**dict.fromkeys([*range(20), *range(100, 160)], 0), 500: 500, 501: 500, 502: 500, 600: 600, 700: 600}


def _shuffles(df):
    """Exchanges of rows in the plan of a step, those sent to all executors not counted."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_small_sides_are_not_shuffled(spark, monkeypatch):
    """Every shuffle costs a task for each shuffle partition: where one side of a join is small, the other stays where it is."""
    from riskweave.llm import components as module
    from riskweave.llm import ngram_join
    rng, n = np.random.default_rng(12), 200
    words = [f"w{k}" for k in range(3000)]
    base = rng.choice(words, 80).tolist()
    texts = [" ".join(w if rng.random() > 0.01 else "other" for w in base) for _ in range(n)]
    texts += [" ".join([*base[:45], *rng.choice(words, 40)]) for _ in range(n)]  # a passage in common
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen, kept = [], ngram_join.staged

    def counted(df, name):
        seen.append((name, _shuffles(df)))
        return kept(df, name)
    monkeypatch.setattr(ngram_join, "staged", counted)
    monkeypatch.setattr(module, "staged", counted)
    found = near_duplicates(frame, limit=4)
    most = {}
    for name, shuffles in seen:
        name = re.sub(r"-\d+$", "", name)
        most[name] = max(shuffles, most.get(name, 0))
    assert {"join-judged", "join-met", "join-exact", "join-members"} <= set(most)
    assert _shuffles(found) == 0
    none = ["join-signatures", "join-judged", "join-groups", "links"]
    assert {k: most[k] for k in none} == dict.fromkeys(none, 0)
    one = ["join-classes", "join-links", "join-pivots", "join-met", "join-sets", "join-exact", "labels", "join-members", "join-heads"]
    assert {k: v for k, v in most.items() if k in one and v > 1} == {}
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found.collect()), key=str) == _brute(list(enumerate(texts)))[0]


def test_few_blocks_end_the_splits(spark, monkeypatch):
    """A level more is a dozen shuffles; where blocks of all that is open are few they are compared at once, with nothing left out."""
    from riskweave.llm import ngram_join
    rng, n = np.random.default_rng(8), 700
    base = np.arange(64, dtype=np.uint32)
    one = np.where(rng.random((n, 64)) < 0.3, base, rng.integers(10 ** 6, 10 ** 9, (n, 64))).astype(np.uint32)
    two = one.copy()
    two[:, np.random.default_rng(20).permutation(64)[:8]] = 7  # positions of level 0
    sigs = [s for pair in zip(one, two) for s in pair]
    frame = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sigs)], "cid long, sig binary").localCheckpoint()
    names, kept = [], ngram_join.staged

    def seen(df, name):
        names.append(name)
        return kept(df, name)
    monkeypatch.setattr(ngram_join, "staged", seen)
    label = {r["node"]: r["label"] for r in components(ngram_join.candidate_links(frame, 0.8, 0.9999, limit=64, levels=6, slack=0.25)).collect()}
    assert all(label[2 * k] == label[2 * k + 1] for k in range(n))
    assert "join-judged-0" in names and "join-paths-1" not in names
    names.clear()
    monkeypatch.setattr(ngram_join, "BLOCK_PAIRS", 0)
    ngram_join.candidate_links(frame, 0.8, 0.9999, limit=64, levels=6, slack=0.25)
    assert "join-paths-1" in names
