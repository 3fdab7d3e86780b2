"""Streaming scorer (S9-S11): the request-per-row scoring service re-aimed as
a Structured Streaming job.

``readStream`` of JSON requests (same plan for a Kafka source) -> contract
check -> scale with the training parameters -> ``PipelineModel.transform``
-> (id, probability, label, threshold). Stateless, so append mode, no
watermark. Each micro-batch writes scored rows and rejects into folders
named by batch id with overwrite, so a retried batch replaces its own output
(idempotent sink); the checkpoint lives in the shared checkpoint folder.
"""

from __future__ import annotations

import os
import threading
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from riskweave.operators import contract as C
from riskweave.operators import score as S
from riskweave.session import scratch_path


def request_schema(features: Sequence[str], id_col: str) -> T.StructType:
    return T.StructType([T.StructField(id_col, T.LongType(), True)] +
                        [T.StructField(f, T.DoubleType(), True) for f in features])


def score_batch(batch: DataFrame, model: PipelineModel, features: Sequence[str], params: dict,
                threshold: float, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected) for one batch; the stream and batch paths share it."""
    ok, bad = C.split_rows(batch, features)
    scored = S.score(ok, model, features, params, threshold, id_col)
    rejected = bad.select(id_col, "missing_features")
    return scored, rejected


def score_stream(spark: SparkSession, source, model: PipelineModel, features: Sequence[str],
                 params: dict, threshold: float, sink_dir: str, reject_dir: str, checkpoint_dir: str,
                 id_col: str = "SK_ID_CURR", available_now: bool = True, max_files_per_trigger: int = 100,
                 sink_format: str = "parquet", log_dir: str | None = None):
    """``source``: a folder of JSON requests, or any streaming DataFrame with
    the id and feature columns (e.g. a Kafka stream parsed with
    ``from_json``): the plan downstream is the same. ``sink_format``:
    ``parquet`` or ``csv`` (with header) for the predictions and rejects.
    ``log_dir`` gets one row for every micro-batch: rows in, scored and
    rejected, written with the batch, so none is forgotten and a retried batch
    replaces its own."""
    if isinstance(source, str):
        schema = request_schema(features, id_col)
        requests = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                         .json(source))
    else:
        requests = source.select(F.col(id_col).cast("long").alias(id_col),
                                 *[F.col(f).cast("double").alias(f) for f in features])

    def write(df: DataFrame, path: str) -> None:
        w = df.write.mode("overwrite")
        (w.option("header", True).csv(path) if sink_format == "csv" else w.parquet(path))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # parsed once for both outputs and the counts
        try:
            scored, rejected = score_batch(batch, model, features, params, threshold, id_col)
            write(scored, os.path.join(sink_dir, f"batch_id={batch_id}"))
            write(rejected, os.path.join(reject_dir, f"batch_id={batch_id}"))
            if log_dir is not None:
                lacks = C.missing_features(features).isNotNull()
                counts = batch.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(~lacks).alias("scored_rows"), F.count_if(lacks).alias("rejected_rows"),
                                   F.current_timestamp().alias("ts"))
                counts.write.mode("overwrite").parquet(os.path.join(log_dir, f"batch_id={batch_id}"))
        finally:
            batch.unpersist()

    w = requests.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


PROGRESS = "query_id string, batch_id long, input_rows long, rows_per_second double, duration_ms long, ts string"


class ProgressLog(StreamingQueryListener):
    """The engine's progress of every micro-batch, kept beyond the few that a query remembers.

    Registered before a query starts (``spark.streams.addListener``). Rows go to
    ``path`` every ``flush`` batches, from a thread of their own, since a
    listener that waits for a job holds up the events behind it; ``finish``
    waits for the end of a query and writes what is left. ``read`` gives each
    batch once, though a restarted query reports its last one again.
    """

    def __init__(self, spark: SparkSession, path: str, flush: int = 50):
        self.spark, self.path, self.flush = spark, path, flush
        self.held: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()
        self.writers: list[threading.Thread] = []

    def onQueryStarted(self, event) -> None:  # noqa: N802 - names that Spark calls
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        with self.changed:
            self.held.append((str(p.id), p.batchId, p.numInputRows, float(p.inputRowsPerSecond or 0.0), p.durationMs.get("triggerExecution"), p.timestamp))
            if len(self.held) >= self.flush:
                rows, self.held = self.held, []
                self.writers = [w for w in self.writers if w.is_alive()] + [threading.Thread(target=self._write, args=(rows,))]
                self.writers[-1].start()

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def _write(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def finish(self, query, seconds: float = 60.0) -> None:
        """Write all progress of a query that was stopped or has drained its source."""
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds):
                raise TimeoutError("the end of the query was not reported")
            rows, self.held = self.held, []
        for w in self.writers:
            w.join()
        if rows:
            self._write(rows)

    @staticmethod
    def read(spark: SparkSession, path: str) -> DataFrame:
        rows = spark.read.schema(PROGRESS).parquet(path)
        return rows.groupBy("query_id", "batch_id").agg(F.max_by(F.struct("input_rows", "rows_per_second", "duration_ms", "ts"), "ts").alias("p")).select(
            "query_id", "batch_id", "p.*")


def read_batches(spark: SparkSession, log_dir: str) -> DataFrame:
    """batch_id, input_rows, scored_rows, rejected_rows, ts of every batch that the sink wrote."""
    return spark.read.schema("input_rows long, scored_rows long, rejected_rows long, ts timestamp, batch_id long").parquet(log_dir)


def log_batches(spark: SparkSession, log_dir: str, path: str, experiment: str = "scoring_stream", tags: dict | None = None) -> None:
    """One run for each micro-batch in the run table."""
    from riskweave.sources import runs
    long = runs.metrics_to_runs(read_batches(spark, log_dir), F.concat(F.lit("batch="), F.col("batch_id").cast("string")),
                                ["batch_id"], ["input_rows", "scored_rows", "rejected_rows"], experiment, tags)
    runs.append_runs(long, path)


def run_once(spark: SparkSession, requests: DataFrame, model: PipelineModel, features: Sequence[str],
             params: dict, threshold: float, id_col: str = "SK_ID_CURR", max_files_per_trigger: int = 100) -> dict:
    """Write ``requests`` as JSON files, drain them with an availableNow
    stream and return the scored, rejected, batch and progress frames."""
    src, out, rej, ck, log, seen = (scratch_path(spark, n) for n in ("requests", "scored", "rejected", "stream-ckpt", "stream-batches", "stream-progress"))
    requests.select(id_col, *features).write.mode("overwrite").json(src)
    listener = ProgressLog(spark, seen)
    spark.streams.addListener(listener)
    try:
        q = score_stream(spark, src, model, features, params, threshold, out, rej, ck, id_col, log_dir=log,
                         max_files_per_trigger=max_files_per_trigger)
        q.awaitTermination()
        listener.finish(q)
    finally:
        spark.streams.removeListener(listener)
    from riskweave.sources import runs
    log_batches(spark, log, runs.run_table_path(spark), tags={"stream": os.path.basename(src)})
    return {"scored": spark.read.parquet(out).drop("batch_id"),
            "rejected": spark.read.parquet(rej).drop("batch_id"),
            "batches": read_batches(spark, log),
            "progress": ProgressLog.read(spark, seen)}
