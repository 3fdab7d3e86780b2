"""Fitted encoders from disk, the shared run table, CSV rejects and the streaming logs."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from riskweave.operators.fitted import CategoryEncoder, MedianFill, PopulationScaler
from riskweave.session import scratch_path
from riskweave.sources import io, runs
from riskweave.streaming import scoring

TRAIN = [("a", "x", 1.0), ("b", None, 3.0), ("c", "y", float("nan")), ("b", "x", None), ("a", "y", 5.0)]
KIND = "big string, small string, n double"


def _saved(spark, pipeline, train):
    path = scratch_path(spark, "pipeline")
    pipeline.fit(train).write().save(path)
    return PipelineModel.load(path)


def test_pipeline_from_disk(spark):
    train = spark.createDataFrame(TRAIN, KIND)
    model = _saved(spark, Pipeline(stages=[MedianFill(["n"]), PopulationScaler(["n"]), CategoryEncoder(["big"]),
                                           CategoryEncoder(["small"], kind="onehot")]), train)
    rows = spark.createDataFrame([("b", "y", 3.0), ("zz", "q", None), (None, None, 7.0), ("c", "x", float("nan"))], KIND)
    got = model.transform(rows).collect()
    assert got[0].asDict().keys() == {"big", "n", "small_Unknown", "small_x", "small_y"}
    assert [r["big"] for r in got] == [1, -1, -1, 2]                       # unseen, and missing where no training row lacked it
    assert [(r["small_Unknown"], r["small_x"], r["small_y"]) for r in got] == [(0, 0, 1), (0, 0, 0), (1, 0, 0), (0, 1, 0)]
    sd = (sum((x - 3) ** 2 for x in (1, 3, 3, 3, 5)) / 5) ** 0.5             # median 3 fills, mean 3
    assert [r["n"] for r in got] == pytest.approx([0, 0, 4 / sd, 0])
    assert model.transform(rows.limit(0)).collect() == []


def test_unseen_may_fail_and_constants_divide_by_one(spark):
    train = spark.createDataFrame(TRAIN, KIND).withColumn("one", F.lit(2))
    for kind in ("codes", "onehot"):
        model = _saved(spark, Pipeline(stages=[CategoryEncoder(["big"], kind=kind, unseen="error")]), train)
        assert model.transform(train).count() == 5
        with pytest.raises(PySparkException, match="unseen value"):
            model.transform(spark.createDataFrame([("new", "x", 1.0)], KIND)).collect()
    scaled = _saved(spark, Pipeline(stages=[PopulationScaler(["one"])]), train).transform(train)
    assert {r["one"] for r in scaled.collect()} == {0.0}
    empty = _saved(spark, Pipeline(stages=[MedianFill(["n"]), CategoryEncoder(["big"])]), train.limit(0)).transform(train)
    assert {r["big"] for r in empty.collect()} == {-1} and empty.where("n is null").count() == 2


def test_many_values_are_joined(spark):
    train = spark.range(0, 3000, 3).select(F.format_string("v%05d", "id").alias("big"))
    model = _saved(spark, Pipeline(stages=[CategoryEncoder(["big"])]), train)
    rows = spark.range(0, 3000).select(F.format_string("v%05d", "id").alias("big"), "id", F.lit(1).alias("value"), F.lit(1).alias("pos"))
    got = model.transform(rows)
    assert got.columns == rows.columns
    assert all(r["big"] == (r["id"] // 3 if r["id"] % 3 == 0 else -1) for r in got.collect())


def test_run_table_is_shared_idempotent_and_compacted(spark):
    path = scratch_path(spark, "runtable")
    assert runs.read_log(spark, path).count() == 0 and runs.read_runs(spark, path, "none").count() == 0
    sweep = spark.createDataFrame([(0.2, 30.0), (0.5, 10.0), (0.35, 10.0)], "threshold double, cost double")
    name = F.concat(F.lit("t="), F.col("threshold").cast("string"))
    log = lambda frame, data: runs.append_runs(runs.metrics_to_runs(frame, name, ["threshold"], ["cost"], "sweep", {"data": data}), path)
    log(sweep, "one"), log(sweep, "two"), log(sweep, "one")               # a retried job
    assert runs.read_runs(spark, path, "sweep").count() == 6
    one = runs.read_runs(spark, path, "sweep", {"data": "one"})
    assert one.count() == 3 and runs.best_run(one, "cost", prefer={"threshold": 0.5}).first()["run_name"] == "t=0.5"
    first = runs.log_run(spark, path, "other", "a", {"p": 1}, {"cost": 1.0})
    before = sorted(map(tuple, runs.read_log(spark, path).drop("ts").collect()))
    assert runs.compact_runs(spark, path) == len(before)
    assert sorted(map(tuple, runs.read_log(spark, path).drop("ts").collect())) == before
    assert not [d for d in os.listdir(os.path.join(path, "log")) if os.listdir(os.path.join(path, "log", d))]
    log(sweep.withColumn("cost", F.lit(1.0)), "one")                       # logged again: the new values count
    assert {r["cost"] for r in runs.read_runs(spark, path, "sweep", {"data": "one"}).collect()} == {1.0}
    assert runs.log_run(spark, path, "other", "a", {"p": 2}, {"cost": 2.0}) == first
    assert runs.compact_runs(spark, path) == len(before) and len(os.listdir(os.path.join(path, "base"))) <= 2
    assert [r["p"] for r in runs.read_runs(spark, path, "other").collect()] == ["2"]
    assert runs.run_table_path(spark) == runs.run_table_path(spark)


def test_csv_rejects(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,price,day,name\n1,2.5,3,x\n2,abc,NA,"a, b"\n3,NaN,x,y\n4,1.0\n5,1,2,z,extra\n6,,,\n,1e3,7,null\nseven,?,1.5,n\n')
    rows, rejects = io.read_csv_checked(spark, str(tmp_path / "in.csv"), "id long, price double, day int, name string")
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [(None, 1000.0, 7, None), (1, 2.5, 3, "x"), (6, None, None, None)]
    bad = {r["record"]: r["bad_columns"] for r in rejects.collect()}
    assert set(bad) == {"2,abc,NA,a, b", "3,NaN,x,y", "4,1.0", "5,1,2,z,extra", "seven,?,1.5,n"}
    assert bad["2,abc,NA,a, b"] == ["price"] and bad["3,NaN,x,y"] == ["day"] and bad["4,1.0"] == bad["5,1,2,z,extra"] == []
    assert {r["cause"]: r["records"] for r in io.reject_counts(rejects).collect()} == {"price": 2, "day": 2, "fields": 2, "id": 1}


def test_every_batch_is_logged(spark):
    path, state = scratch_path(spark, "progress"), scratch_path(spark, "progress-ckpt")
    listener = scoring.ProgressLog(spark, path, flush=30)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 4).option("numPartitions", 1).load()
        q = stream.writeStream.foreachBatch(lambda batch, k: None).option("checkpointLocation", state).trigger(processingTime="0 seconds").start()
        while (q.lastProgress or {}).get("batchId", 0) < 120:
            q.awaitTermination(1)
        assert len(q.recentProgress) <= 100  # what a query remembers
        q.stop()
        listener.finish(q)
    finally:
        spark.streams.removeListener(listener)
    got = scoring.ProgressLog.read(spark, path)
    ids = sorted(r["batch_id"] for r in got.collect())
    assert ids == list(range(len(ids))) and len(ids) > 100
