"""Session helpers.

The library never creates hidden sessions inside operators; callers pass a
``SparkSession``. ``get_session`` is a convenience for tests, the bench and
the examples. Settings chosen here are the ones every operator relies on:

* session time zone UTC (fixtures are ``TIMESTAMP_NTZ``; results must not move
  with the driver's local zone),
* AQE on, so shuffle partition counts coalesce at run time and skewed join
  partitions are split,
* a checkpoint directory only when the cluster has not configured one.
"""

from __future__ import annotations

import os
import shlex
import tempfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "aerolith", cpus: int | str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the library's defaults.

    Where ``spark-submit`` or the environment names a master, it stays, and so do the cluster's partitions and memory;
    local masters get ``cpus`` threads and few shuffle partitions. ``shuffle_partitions`` holds anywhere.
    """
    builder = SparkSession.builder.appName(app)
    master = SparkContext._active_spark_context.master if SparkContext._active_spark_context else _submitted_master()
    if master is None or master.startswith("local"):
        cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
        shuffle_partitions = shuffle_partitions or int(os.environ.get("AEROLITH_SHUFFLE_PARTITIONS", "8"))
        builder = builder.master(f"local[{cpus}]").config("spark.driver.memory", os.environ.get("AEROLITH_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _submitted_master() -> str | None:
    """The master that ``spark-submit`` or PYSPARK_SUBMIT_ARGS names, if any."""
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    named = [b for a, b in zip(args, args[1:]) if a == "--master"]
    return named[-1] if named else os.environ.get("SPARK_MASTER") or os.environ.get("MASTER")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset.

    On a cluster the directory must be shared storage configured by the
    operator of the cluster; a machine-local folder is only acceptable for
    local test sessions, which is the only case where we create one.
    """
    conf = spark.sparkContext.getConf()
    current = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        # executors on other machines cannot read a folder on the driver's disk
        raise RuntimeError("set spark.checkpoint.dir to shared storage (HDFS/S3/...) for cluster runs")
    path = tempfile.mkdtemp(prefix="aerolith-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (survives executor loss) and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
