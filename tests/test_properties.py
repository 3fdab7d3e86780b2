"""Properties: brute-force equivalence, symmetry, partition independence,
stream = batch."""

import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import aggregate as agg
from riskweave.operators import encode as E
from riskweave.operators import evaluate as EV


def _auc_brute(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_exact_and_symmetric(spark):
    rnd = random.Random(7)
    pairs = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(pairs, "y int, s double")
    auc = EV.roc_auc(df, "s", "y", n_buckets=16).first()["auc"]
    assert auc == pytest.approx(_auc_brute(pairs))
    neg = EV.roc_auc(df.withColumn("s", -F.col("s")), "s", "y", n_buckets=16).first()["auc"]
    assert auc + neg == pytest.approx(1.0)


def test_prefix_before_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 2), rnd.randint(1, 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int, v long")
    out = {r["id"]: r["v_before"] for r in EV.prefix_before(df, ["id"], ["v"], part=["g"], n_buckets=7).collect()}
    for i, g, _ in rows:
        assert out[i] == sum(v for j, gg, v in rows if gg == g and j < i)


def test_stratified_folds_balanced(spark):
    rows = [(i, 1 if i % 3 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, y int")
    folds = EV.stratified_folds(df, "id", "y", 5, n_buckets=9)
    counts = folds.groupBy("y", "fold").count().collect()
    by_class = {}
    for r in counts:
        by_class.setdefault(r["y"], []).append(r["count"])
    for cs in by_class.values():
        assert max(cs) - min(cs) <= 1 and len(cs) == 5
    seeded = EV.stratified_folds(df, "id", "y", 5, seed=42, n_buckets=9)
    assert seeded.groupBy("fold").count().count() == 5


def test_two_level_equals_nested_brute_force(spark):
    rnd = random.Random(11)
    links = [(c, 100 * c + k) for c in range(20) for k in range(rnd.randint(0, 4))]
    child = [(loan, float(rnd.randint(-5, 5))) for _, loan in links for _ in range(rnd.randint(0, 3))]
    ldf = spark.createDataFrame(links, "c long, loan long")
    cdf = spark.createDataFrame(child, "loan long, x double")
    out = {r["c"]: r for r in agg.two_level_agg(cdf, ldf, "loan", "c", {"x": ["sum", "max"]}, "P").collect()}
    for c in {c for c, _ in links}:
        sums, maxs = [], []
        for cc, loan in links:
            if cc != c:
                continue
            xs = [x for ll, x in child if ll == loan]
            sums.append(sum(xs))           # pandas: all-missing sum is 0
            maxs.append(max(xs) if xs else None)
        s_vals = [s for s, m in zip(sums, maxs)]
        has_rows = [bool([x for ll, x in child if ll == loan]) for cc, loan in links if cc == c]
        lvl_sums = [s for s, h in zip(s_vals, has_rows) if h]
        exp_mean = sum(lvl_sums) / len(lvl_sums) if lvl_sums else None
        got = out[c]["P_P_x_SUM_MEAN"]
        assert (got is None and exp_mean is None) or got == pytest.approx(exp_mean)


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c")], "k long, s string")
    out = agg.category_shares(df, "k", "s").collect()
    for r in out:
        assert sum(v for k, v in r.asDict().items() if k != "k") == pytest.approx(1.0)


def test_one_hot_rows_sum_to_one(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id long, c string")
    out = E.one_hot(df, ["c"])
    assert out.columns == ["id", "c_Unknown", "c_x", "c_y"]
    assert all(sum(r[1:]) == 1 for r in out.collect())


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_partition_independence(spark, parts):
    from tests.conftest import SF_SMALL
    import __spark_entry__ as entry
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        q = entry.queries()
        got = sorted(tuple(r) for r in q["two_level_agg"](spark, SF_SMALL).collect())
        auc = q["roc_auc"](spark, SF_SMALL).first()["auc"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    base = sorted(tuple(r) for r in entry.queries()["two_level_agg"](spark, SF_SMALL).collect())
    assert got == base
    assert auc == entry.queries()["roc_auc"](spark, SF_SMALL).first()["auc"]


def test_stream_equals_batch(spark):
    from riskweave.operators import score as S
    from riskweave.streaming import scoring
    rows = [(i, float(i % 7), float((i * 3) % 5), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, a double, b double, y int")
    model, params = S.fit_pipeline(df, ["a", "b"], "y", S.ModelSpec("lr", "logreg", max_iter=20))
    req = df.withColumn("b", F.when(F.col("SK_ID_CURR") == 5, F.lit(None)).otherwise(F.col("b")))
    out = scoring.run_once(spark, req, model, ["a", "b"], params, 0.5)
    streamed = {r["SK_ID_CURR"]: (r["TARGET_proba"], r["TARGET"]) for r in out["scored"].collect()}
    batch_ok, _ = scoring.score_batch(req, model, ["a", "b"], params, 0.5, "SK_ID_CURR")
    batch = {r["SK_ID_CURR"]: (r["TARGET_proba"], r["TARGET"]) for r in batch_ok.collect()}
    assert streamed.keys() == batch.keys() and 5 not in streamed
    for k in batch:
        assert streamed[k][0] == pytest.approx(batch[k][0]) and streamed[k][1] == batch[k][1]
    assert [r["SK_ID_CURR"] for r in out["rejected"].collect()] == [5]


def test_gram_correlation_equals_aggregate_route(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(500):
        a = rnd.gauss(1000, 50)
        rows.append((a, None if rnd.random() < 0.2 else 2 * a + rnd.gauss(0, 5),
                     None if rnd.random() < 0.1 else rnd.gauss(0, 1), 3.0))
    df = spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(4)
    cols = ["a", "b", "c", "k"]
    from riskweave.operators import profile as PR
    agg_r = {(r["i"], r["j"]): r["r"] for r in PR.correlation_pairs(df, cols, "aggregate").collect()}
    gram_r = {(r["i"], r["j"]): r["r"] for r in PR.correlation_pairs(df, cols, "gram").collect()}
    assert agg_r.keys() == gram_r.keys()
    for k in agg_r:
        if agg_r[k] is None:
            assert gram_r[k] is None
        else:
            assert gram_r[k] == pytest.approx(agg_r[k], abs=1e-9)


def test_label_encode_many_values_path(spark, monkeypatch):
    from riskweave.operators import encode as E
    monkeypatch.setattr(E, "MAX_INLINE_VALUES", 3)
    df = spark.createDataFrame([(v,) for v in ["d", "b", None, "a", "c", "b"]], "c string")
    got = sorted((r[0] for r in E.label_encode(df, ["c"]).collect()))
    # Unknown 0, a 1, b 2, c 3, d 4
    assert got == [0, 1, 2, 2, 3, 4]


@pytest.mark.parametrize("n", [1, 2, 7, 1000, 1001])
def test_exact_median_selection_matches_aggregate(spark, n):
    from riskweave.operators import encode as E
    rnd = random.Random(n)
    rows = [(None if rnd.random() < 0.1 else float(rnd.randint(-50, 50)) / 4,
             float(rnd.choice([1.0, 1.0, 1.0, 2.5])), rnd.gauss(0, 1e6)) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    ref = E.medians(df, ["a", "b", "c"], method="aggregate")
    sel = E.exact_medians(df, ["a", "b", "c"], buckets=8, final_rows=10)
    for c in "abc":
        assert (ref[c] is None and sel[c] is None) or sel[c] == ref[c], c


def test_cost_by_sweep_equals_direct_count(spark):
    rnd = random.Random(9)
    rows = [(rnd.randint(0, 4), rnd.random(), rnd.randint(0, 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "fold int, p double, y int")
    sweep = {r.threshold: r.mean_cost for r in EV.threshold_sweep(df, "p", "y", "fold").collect()}
    for t in EV.THRESHOLDS:
        per_fold = []
        for f in range(5):
            fn = sum(1 for ff, p, y in rows if ff == f and y == 1 and p < t)
            fp = sum(1 for ff, p, y in rows if ff == f and y == 0 and p >= t)
            per_fold.append(10 * fn + fp)
        assert sweep[t] == pytest.approx(sum(per_fold) / 5)


def test_correlation_filter_idempotent(spark):
    from riskweave.operators import select as SEL
    rnd = random.Random(4)
    rows = []
    for _ in range(200):
        a = rnd.random()
        rows.append((a, a * 3 + 1e-3 * rnd.random(), rnd.random(), 0))
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    once, dropped = SEL.remove_high_correlation(df, "y", 0.95)
    assert dropped == ["b"]
    twice, dropped2 = SEL.remove_high_correlation(once, "y", 0.95)
    assert dropped2 == [] and twice.columns == once.columns


def test_stream_from_a_streaming_frame_to_csv(spark):
    import os
    from riskweave.operators import score as S
    from riskweave.session import scratch_path
    from riskweave.streaming import scoring
    rows = [(i, float(i % 7), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "SK_ID_CURR long, a double, y int")
    model, params = S.fit_pipeline(df, ["a"], "y", S.ModelSpec("lr", "logreg", max_iter=10))
    src = scratch_path(spark, "t-src")
    df.select("SK_ID_CURR", "a").write.json(src)
    stream = spark.readStream.schema("SK_ID_CURR long, a double").json(src)
    out, rej, ck = (scratch_path(spark, n) for n in ("t-out", "t-rej", "t-ck"))
    q = scoring.score_stream(spark, stream, model, ["a"], params, 0.5, out, rej, ck, sink_format="csv")
    q.awaitTermination()
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 40 and "TARGET_proba" in back.columns
    assert os.path.isdir(out)


def test_category_share_paths_agree(spark):
    rnd = random.Random(13)
    vals = [f"s{i}" for i in range(80)]
    rows = [(rnd.randint(0, 30), rnd.choice(vals + [None]), rnd.randint(-50, 0)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k long, s string, m int")
    spec = {"m": ["min", "max", "size"]}
    a = {r["k"]: r.asDict() for r in agg.category_shares(df, "k", "s", spec=spec, method="expr").collect()}
    b = {r["k"]: r.asDict() for r in agg.category_shares(df, "k", "s", spec=spec, method="auto").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k].keys() == b[k].keys()
        for c in a[k]:
            assert a[k][c] == pytest.approx(b[k][c]), (k, c)
