"""Sources and sinks: CSV missing tokens, stages, feature lists, run store."""

import os
import tempfile

from pyspark.sql import functions as F

from riskweave.sources import io, runs


def test_csv_missing_tokens(spark):
    d = tempfile.mkdtemp(prefix="rw-csv-")
    path = os.path.join(d, "t.csv")
    with open(path, "w") as f:
        f.write("id,x,s\n1,1.5,a\n2,NA,\n3,,null\n4,NaN,None\n5,2,N/A\n")
    df = io.read_csv(spark, path, "id long, x double, s string")
    rows = [(r.id, r.x, r.s) for r in df.orderBy("id").collect()]
    assert rows == [(1, 1.5, "a"), (2, None, None), (3, None, None), (4, None, None), (5, 2.0, None)]


def test_stage_and_feature_list_roundtrip(spark):
    from riskweave.session import scratch_path
    df = spark.range(5).withColumn("y", F.col("id") * 2)
    back = io.checkpoint_stage(spark, df, scratch_path(spark, "t-stage"))
    assert sorted(r.y for r in back.collect()) == [0, 2, 4, 6, 8]
    p = scratch_path(spark, "t-list")
    io.save_feature_list(spark, ["b", "a", "c"], p)
    assert io.load_feature_list(spark, p) == ["b", "a", "c"]
    assert io.profile(df) == (5, 2)


def test_run_store_reader(spark):
    root = tempfile.mkdtemp(prefix="rw-runs-")
    for run, auc, cost in (("r1", 0.78, 30455.4), ("r2", 0.77, 31669.4)):
        m = os.path.join(root, "7", run, "metrics")
        os.makedirs(m)
        with open(os.path.join(m, "mean_auc"), "w") as f:
            f.write(f"1700000000000 0.5 0\n1700000001000 {auc} 0\n")
        with open(os.path.join(m, "cost"), "w") as f:
            f.write(f"1700000001000 {cost} 0\n")
        pdir = os.path.join(root, "7", run, "params")
        os.makedirs(pdir)
        with open(os.path.join(pdir, "threshold"), "w") as f:
            f.write("0.5")
    long = runs.read_run_store(spark, root)
    got = {(r.run_id, r.key): r.value for r in long.collect()}
    assert got[("r1", "mean_auc")] == "0.78" and got[("r2", "threshold")] == "0.5"
    table = os.path.join(tempfile.mkdtemp(prefix="rw-rt-"), "runs")
    runs.append_runs(long.withColumn("ts", F.col("ts")), table)
    wide = runs.read_runs(spark, table, "7")
    best = runs.best_run(wide, "cost", ascending=True).first()
    assert best.run_name == "r1" and best.cost == 30455.4


def test_log_run_and_best(spark):
    table = os.path.join(tempfile.mkdtemp(prefix="rw-log-"), "runs")
    runs.log_run(spark, table, "exp", "a", {"threshold": 0.5}, {"cost": 10.0})
    runs.log_run(spark, table, "exp", "b", {"threshold": 0.3}, {"cost": 7.0})
    best = runs.best_run(runs.read_runs(spark, table, "exp"), "cost").first()
    assert best.run_name == "b"


def test_bucketed_children_need_no_shuffle_before_the_link_join(spark):
    import re
    from riskweave.operators import aggregate as agg
    from riskweave.sources.io import save_bucketed
    links = spark.createDataFrame([(c, 10 * c + k) for c in range(50) for k in range(3)],
                                  "SK_ID_CURR long, SK_ID_PREV long")
    child = spark.createDataFrame([(10 * c + k, float(c + k)) for c in range(50) for k in range(3) for _ in range(2)],
                                  "SK_ID_PREV long, x double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        save_bucketed(links, "t_links_b", "SK_ID_PREV", 4)
        save_bucketed(child, "t_child_b", "SK_ID_PREV", 4)
        out = agg.two_level_agg(spark.table("t_child_b"), spark.table("t_links_b"), "SK_ID_PREV", "SK_ID_CURR",
                                {"x": ["sum"]}, "C")
        plan = out._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Exchange hashpartitioning\(([A-Za-z_]+)", plan)
        assert keys and all(k == "SK_ID_CURR" for k in keys)   # only the client-level shuffle
        assert out.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS t_links_b")
        spark.sql("DROP TABLE IF EXISTS t_child_b")


def test_checkpoint_stage_observes_shape(spark):
    from riskweave.session import scratch_path
    shapes = {}
    df = spark.range(7).withColumn("y", F.col("id") + 1)
    back = io.checkpoint_stage(spark, df, scratch_path(spark, "t-obs"), shapes, "s")
    assert shapes == {"s": (7, 2)} and back.count() == 7
