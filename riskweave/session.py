"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at any scale: AQE re-plans shuffles at run time
# (coalesces small partitions, splits skewed join partitions, turns joins
# whose measured side is small into broadcast joins).
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "riskweave", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.

    ``master``/``shuffle_partitions`` are only for local runs and tests; on a
    cluster leave them to the submitter so the cluster defaults apply.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local runs, tests) is a private folder created and registered.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getConf().get("spark.checkpoint.dir") if sc else None)
    if not d:
        master = (sc.master if sc else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for stage "
                               "outputs and checkpoints (a machine-local folder does not survive "
                               "a lost executor)")
        d = tempfile.mkdtemp(prefix="riskweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for stage outputs."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
