"""Run log (S6-S8, K6, M17): one shared table of params and metrics per run.

Runs are rows ``(experiment, run_id, run_name, kind, key, value, ts)``. The
table is a folder below the shared checkpoint folder, so tuning, model
selection and scoring read each other's runs, in this session or a later one:

    log/experiment=.../run_id=.../   a run as it was logged
    base/version=N/                  runs that were compacted into few files

A run's id is a hash of its experiment, tags and name. Logging it again, as a
retried job does, replaces its own folder and nothing else, so appends are
idempotent. Readers take the newest finished base and all of the log; a run in
both counts as logged. :func:`compact_runs` writes the next base and deletes the
log folders that it holds; a reader that listed them just before fails and can
be run again. A tracking-store directory of one-value files
(``<exp>/<run>/metrics/<key>`` holding ``ts value step``) can be read into the
same shape with ``read_run_store``.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.session import ensure_checkpoint_dir

RUN_SCHEMA = ("experiment string, run_id string, run_name string, kind string, key string, "
              "value string, ts timestamp")
COLUMNS = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
UNIT = "\x1f"   # between the parts of what is hashed to a run id


def run_table_path(spark: SparkSession, name: str = "runs") -> str:
    """The shared table: the same folder for every job that names the same checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), f"riskweave-{name}")


def metrics_to_runs(df: DataFrame, run_name: Column, params: Sequence[str], metrics: Sequence[str],
                    experiment: str, tags: Mapping[str, str] | None = None) -> DataFrame:
    """One run per row of ``df`` (e.g. one per threshold or per model); ``tags`` are params of all of them, and of their ids."""
    tags = dict(sorted((tags or {}).items()))
    kv = [F.struct(F.lit("param").alias("kind"), F.lit(p).alias("key"), F.col(p).cast("string").alias("value"))
          for p in params]
    kv += [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in tags.items()]
    kv += [F.struct(F.lit("metric").alias("kind"), F.lit(m).alias("key"), F.col(m).cast("string").alias("value"))
           for m in metrics]
    head = UNIT.join([experiment, *(f"{k}={v}" for k, v in tags.items())])
    return (df.select(run_name.alias("run_name"), F.inline(F.array(*kv)))
              .select(F.lit(experiment).alias("experiment"),
                      F.sha2(F.concat_ws(UNIT, F.lit(head), "run_name"), 256).substr(1, 32).alias("run_id"),
                      "run_name", "kind", "key", "value", F.current_timestamp().alias("ts")))


def log_run(spark: SparkSession, path: str, experiment: str, run_name: str,
            params: Mapping[str, object], metrics: Mapping[str, float], tags: Mapping[str, str] | None = None) -> str:
    """Log one run given on the driver (a handful of numbers)."""
    tags = dict(sorted((tags or {}).items()))
    head = UNIT.join([experiment, *(f"{k}={v}" for k, v in tags.items()), run_name])
    run_id = hashlib.sha256(head.encode()).hexdigest()[:32]
    rows = [(experiment, run_id, run_name, "param", k, str(v)) for k, v in {**params, **tags}.items()]
    rows += [(experiment, run_id, run_name, "metric", k, repr(float(v))) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "experiment string, run_id string, run_name string, kind string, "
                                     "key string, value string").withColumn("ts", F.current_timestamp())
    append_runs(df, path)
    return run_id


def append_runs(runs: DataFrame, path: str) -> None:
    """Log runs; one that was logged before is replaced."""
    (runs.select(*COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("experiment", "run_id").parquet(os.path.join(path, "log")))


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(f.getPath().toString() for f in (found or []))


def _delete(spark: SparkSession, folders: Sequence[str]) -> None:
    for f in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(f)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _newest_base(spark: SparkSession, path: str) -> str | None:
    done = _folders(spark, os.path.join(path, "base", "version=*", "_SUCCESS"))
    return os.path.dirname(done[-1]) if done else None


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All runs as long rows; none if nothing was logged yet."""
    out = spark.createDataFrame([], RUN_SCHEMA)
    base = _newest_base(spark, path)
    if base is not None:
        out = spark.read.schema(RUN_SCHEMA).parquet(base)
    if _folders(spark, os.path.join(path, "log", "*", "*")):
        log = spark.read.schema(RUN_SCHEMA).parquet(os.path.join(path, "log")).select(*COLUMNS)
        out = log if base is None else out.join(log.select("experiment", "run_id").distinct(), ["experiment", "run_id"], "left_anti") \
            .select(*COLUMNS).unionByName(log)
    return out


def compact_runs(spark: SparkSession, path: str) -> int:
    """Write all runs into the next base, one file for each experiment, and delete what it replaces. Returns the rows written."""
    logged, bases = _folders(spark, os.path.join(path, "log", "*", "*")), _folders(spark, os.path.join(path, "base", "version=*"))
    newest = _newest_base(spark, path)
    number = 1 + max((int(b.rsplit("=", 1)[1]) for b in bases), default=0)
    target = os.path.join(path, "base", f"version={number:08d}")
    # A log folder that is written again meanwhile is deleted with this list only if its files were read.
    read_log(spark, path).repartition("experiment").sortWithinPartitions("run_id", "kind", "key").write.parquet(target)
    _delete(spark, [*logged, *([newest] if newest else [])])
    return spark.read.schema(RUN_SCHEMA).parquet(target).count()


def read_runs(spark: SparkSession, path: str, experiment: str | None = None, tags: Mapping[str, str] | None = None) -> DataFrame:
    """Long rows -> one row per run, one column per key (metrics double); of all experiments, or one and its tags."""
    long = read_log(spark, path)
    if experiment is not None:
        long = long.where(F.col("experiment") == F.lit(experiment))
    for k, v in (tags or {}).items():
        tagged = long.where((F.col("key") == F.lit(k)) & (F.col("value") == F.lit(v))).select("experiment", "run_id")
        long = long.join(tagged, ["experiment", "run_id"], "left_semi")
    # Keys are the few param / metric names, not data.
    kinds = {r["key"]: r["kind"] for r in long.select("key", "kind").distinct().collect()}
    wide = long.groupBy("experiment", "run_id", "run_name").pivot("key", sorted(kinds)).agg(F.first("value")) if kinds else \
        long.select("experiment", "run_id", "run_name")
    return wide.select("experiment", "run_id", "run_name", *[
        F.col(k).cast("double").alias(k) if kinds[k] == "metric" else F.col(k) for k in sorted(kinds)])


def read_run_store(spark: SparkSession, root: str) -> DataFrame:
    """Tracking-store folders -> long run rows (latest value per key)."""
    files = (spark.read.option("wholetext", True).text(os.path.join(root, "*", "*", "*", "*"))
                  .withColumn("path", F.input_file_name()))
    parts = r"/([^/]+)/([^/]+)/(metrics|params)/([^/]+)$"
    rows = files.select(
        F.regexp_extract("path", parts, 1).alias("experiment"),
        F.regexp_extract("path", parts, 2).alias("run_id"),
        F.regexp_extract("path", parts, 3).alias("kind_dir"),
        F.regexp_extract("path", parts, 4).alias("key"),
        F.explode(F.split(F.trim(F.col("value")), "\n")).alias("line"))
    is_metric = F.col("kind_dir") == "metrics"
    fields = F.split(F.trim(F.col("line")), " ")
    out = rows.select(
        "experiment", "run_id", F.col("run_id").alias("run_name"),
        F.when(is_metric, F.lit("metric")).otherwise(F.lit("param")).alias("kind"), "key",
        F.when(is_metric, fields.getItem(1)).otherwise(F.col("line")).alias("value"),
        F.when(is_metric, F.timestamp_millis(fields.getItem(0).cast("long"))).alias("ts"))
    w = Window.partitionBy("experiment", "run_id", "key").orderBy(F.col("ts").desc_nulls_last())
    return out.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def best_run(wide: DataFrame, metric: str, ascending: bool = True,
             prefer: Mapping[str, object] | None = None) -> DataFrame:
    """K6: runs with the metric present, ordered (ascending = lower is
    better), first row. ``prefer`` puts runs matching the given values first
    among equal metrics."""
    order = [F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()]
    for k, v in (prefer or {}).items():
        order.append((F.col(k).cast("double") != F.lit(v)).cast("int"))
    order.append(F.col("run_name"))
    return wide.where(F.col(metric).isNotNull()).orderBy(*order).limit(1)
