"""Session helpers: a configured local session for tests and the bench, the
checkpoint folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "acctpulse",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.sql.parquet.aggregatePushdown", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


PARTITION_BYTES = 1 << 30   # target of the widest shuffle, before adaptive coalescing
MAX_PARTITIONS = 50_000     # keeps map statuses and shuffle blocks of one job in bounds


def cluster_conf(shuffle_bytes: int, executors_cores: int, checkpoint_dir: str) -> dict[str, str]:
    """Settings for a cluster run, sized from what the widest shuffle writes (the
    de-duplication of the projected events, not the raw tables): about 1 GB a
    partition, never fewer than two per core.  All other shuffles carry
    pre-aggregated rows; adaptive execution coalesces them and splits skew."""
    partitions = min(max(2 * executors_cores, -(-shuffle_bytes // PARTITION_BYTES)), max(MAX_PARTITIONS, 2 * executors_cores))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.aggregatePushdown": "true",
        "spark.checkpoint.dir": checkpoint_dir,
    }


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # a session without a local SparkContext (e.g. Spark Connect)
        return None


def _master(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, as named by the cluster in
    ``spark.checkpoint.dir``.  Only a local-mode session (tests, the bench)
    without one gets a fresh scratch folder; a cluster must name a shared one."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc is not None:
        named = sc.getConf().get("spark.checkpoint.dir")
    if not named and (_master(spark) == "local" or _master(spark).startswith("local[")):
        named = tempfile.mkdtemp(prefix="acctpulse-ckpt-", dir=os.environ.get("ACCTPULSE_SCRATCH"))
    if not named:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for lineage cuts")
    if sc is not None:
        sc.setCheckpointDir(named)
        return sc.getCheckpointDir() or named
    return named


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return a lazy read of it: later actions neither recompute the plan nor
    depend on executors that may be lost, and readers prune columns.  (An RDD
    checkpoint would run the final stage twice: once to count, once to save.)"""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/acctpulse/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def broadcast_if_bounded(df: DataFrame, row_bound: int, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only when ``row_bound`` (a proven upper bound on its
    rows) is within ``max_rows``; otherwise leave the join to a shuffle, where
    adaptive execution still may broadcast it from the measured size."""
    return F.broadcast(df) if row_bound <= max_rows else df
