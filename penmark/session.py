"""Session construction and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Used only when the session names no checkpoint folder (local runs, tests).
_LOCAL_FALLBACK_DIR = "/tmp/penmark-checkpoints"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "penmark") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Only when the session names none (a local run) is a fallback set.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc.getCheckpointDir()
    if current:
        return current
    base = configured or _local_fallback(sc)
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def _local_fallback(sc) -> str:
    """A folder of this machine, which only a session without other machines may use."""
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _LOCAL_FALLBACK_DIR


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local on a cluster)."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    base = configured or sc.getCheckpointDir() or _local_fallback(sc)
    return "/".join([base.rstrip("/"), "penmark", *parts, uuid.uuid4().hex])


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin a scan that arrived in fewer partitions than the cluster has cores.

    A single-row-group file is read by one task; the text work that follows is CPU
    bound, so spreading it pays for the shuffle. At scale the scan already has
    thousands of splits and this is a no-op.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back.

    For tables that several branches or iterations read: the lineage is cut, a lost
    executor costs no recomputation, and later readers get column pruning.
    """
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
