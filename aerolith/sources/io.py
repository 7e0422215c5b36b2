"""Readers and writers (IO1-IO4, IO9-IO15).

All file locations are resolved against shared storage: an explicit path,
or ``spark.aerolith.scratch.dir``, or a folder under the cluster's
``spark.checkpoint.dir`` (never a machine-local temp folder on a cluster).
Reads always use a declared schema; writes are task-parallel.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.sources import manifest as M
from aerolith.session import ensure_checkpoint_dir

# The reference's entity dimension (entity -> latitude, longitude).
ENTITY_COORDINATES = [
    ("Lahore", 31.5497, 74.3436),
    ("Karachi", 24.8607, 67.0011),
    ("Islamabad", 33.6844, 73.0479),
    ("Rawalpindi", 33.5651, 73.0169),
    ("Peshawar", 34.0151, 71.5249),
    ("Quetta", 30.1798, 66.9750),
    ("Multan", 30.1575, 71.5249),
    ("Faisalabad", 31.4504, 73.1350),
    ("Hyderabad", 25.3960, 68.3578),
    ("Sialkot", 32.4945, 74.5229),
]
# Microsecond precision in text files (Spark's CSV default keeps milliseconds only).
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder on shared storage for intermediate tables."""
    base = spark.conf.get("spark.aerolith.scratch.dir", None)
    if not base:
        base = ensure_checkpoint_dir(spark).rstrip("/") + "/aerolith-scratch"
    return f"{base}/{name or 'run'}-{uuid.uuid4().hex[:12]}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> DataFrame:
    """IO1: CSV with header and a declared schema; ``strict`` fails on malformed rows."""
    return (spark.read.schema(schema).option("header", True)
            .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
            .option("mode", "FAILFAST" if strict else "PERMISSIVE").csv(path))


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """IO4: JSON documents with a declared schema; invalid JSON fails the read (FAILFAST)."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, max_records_per_file: int | None = None) -> str:
    """IO9/IO10/IO14: task-parallel write (overwrite or append), CSV with header."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def cached_read(spark: SparkSession, path: str, compute, force_refresh: bool = False) -> DataFrame:
    """IO2: read-through cache: parquet at ``path`` if a finished write left its marker there, else compute, write, and read back."""
    if force_refresh or not _exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_first_available(spark: SparkSession, paths: list[str], reader) -> DataFrame:
    """IO3: source fallback: the first existing location wins (driver-side path choice only)."""
    for p in paths:
        if _exists(spark, p):
            return reader(p)
    raise FileNotFoundError(f"none of the sources exist: {paths}")


def keyed_insert(df: DataFrame, path: str, keys=("city", "timestamp"), order=("ingest_seq",), bucket=None) -> M.Snapshot:
    """IO12: insert into a table with one row per key, the newest by ``order``; only the buckets touched are written anew.

    ``bucket`` depends on the key alone; by default the day of a key with a time, else one of 64 by hash.
    """
    if bucket is None:
        bucket = M.bucket_of_day() if "timestamp" in keys else F.pmod(F.xxhash64(*keys), F.lit(64))
    return M.merge_keyed(df, path, list(keys), list(order), bucket)


def read_keyed(spark: SparkSession, path: str, schema) -> DataFrame:
    """IO12: a plain read of the published buckets; keys are unique as they stand."""
    return M.read(spark, path, schema)


def entity_dimension(spark: SparkSession) -> DataFrame:
    """IO15: the static entity dimension with a number for each entity (fixed size, safe to broadcast)."""
    rows = [(i, *e) for i, e in enumerate(ENTITY_COORDINATES)]
    return spark.createDataFrame(rows, "entity_no long, city string, latitude double, longitude double")
