"""Tables that readers see only as published (IO2, IO10, IO12, RG1, SM2-SM5).

A table is a folder with data folders and a log. A writer first writes its data folder, where nobody
looks, then publishes it by creating the next log file, which lists all live data folders with their
tags. A log file is created only where none of its number exists, so of two writers one has to read again and retry; a
writer that dies before that has changed nothing. Readers take the last log file and read its folders alone.

The log is metadata: one entry per live folder, kept small by compaction or one folder per bucket. Data is
read and written by Spark.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_log"
#: commits of one driver follow each other; between drivers the file system decides
_LOCK = threading.Lock()


class Conflict(RuntimeError):
    """Another writer published first."""


@dataclass
class Snapshot:
    """A published state: its number (0: nothing yet) and the live folders with their tags."""

    version: int = 0
    folders: list[dict] = field(default_factory=list)

    def tagged(self, **tags) -> list[dict]:
        return [f for f in self.folders if all(f.get(k) == v for k, v in tags.items())]


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _file(version: int) -> str:
    return f"{version:020d}.json"


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The last published state of the table at ``path``."""
    fs, log = _fs(spark, f"{path}/{LOG}")
    if not fs.exists(log):
        return Snapshot()
    names = sorted(s.getPath().getName() for s in fs.listStatus(log))
    last = next((n for n in reversed(names) if n.endswith(".json")), None)
    if last is None:
        return Snapshot()
    text = spark.read.text(f"{path}/{LOG}/{last}", wholetext=True).first()[0]
    return Snapshot(int(last[:-5]), json.loads(text)["folders"])


def commit(spark: SparkSession, path: str, base: Snapshot, folders: list[dict]) -> Snapshot:
    """Publish ``folders`` as the state after ``base``; ``Conflict`` if there is one already."""
    target = f"{path}/{LOG}/{_file(base.version + 1)}"
    fs, final = _fs(spark, target)
    _, temp = _fs(spark, f"{path}/{LOG}/.{uuid.uuid4().hex}.tmp")
    fs.mkdirs(final.getParent())
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps({"folders": folders}).encode()))
    out.close()
    with _LOCK:
        # a rename onto an existing name fails on HDFS; local file systems need the look before it
        if fs.exists(final) or not fs.rename(temp, final):
            fs.delete(temp, False)
            raise Conflict(target)
    return Snapshot(base.version + 1, folders)


def update(spark: SparkSession, path: str, change: Callable[[Snapshot], list[dict] | None], attempts: int = 20) -> Snapshot:
    """Publish ``change(state)``, reading again after a conflict; None leaves the table as it is."""
    for _ in range(attempts):
        base = snapshot(spark, path)
        folders = change(base)
        if folders is None:
            return base
        try:
            return commit(spark, path, base, folders)
        except Conflict:
            continue
    raise Conflict(path)


def write_folder(df: DataFrame, path: str, name: str = "part", partition_by: str | None = None) -> str:
    """Write a data folder that is not yet visible; its name under ``path``."""
    folder = f"data/{name}-{uuid.uuid4().hex[:12]}"
    w = df.write.partitionBy(partition_by) if partition_by else df.write
    w.parquet(f"{path}/{folder}")
    return folder


def append(df: DataFrame, path: str, **tags) -> Snapshot:
    """Append ``df`` as one folder. With tags, a folder with the same ones makes it a repeat, which changes nothing."""
    spark = df.sparkSession
    if tags and snapshot(spark, path).tagged(**tags):
        return snapshot(spark, path)
    folder = write_folder(df, path)
    return update(spark, path, lambda s: None if tags and s.tagged(**tags) else [*s.folders, {"folder": folder, **tags}])


def read(spark: SparkSession, path: str, schema: T.StructType | str, state: Snapshot | None = None, **tags) -> DataFrame:
    """All rows of the live folders (with ``tags``), each as one table of ``schema``."""
    state = state or snapshot(spark, path)
    folders = [f"{path}/{f['folder']}" for f in state.tagged(**tags)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def _bucketed(spark: SparkSession, path: str, folder: str, column: str) -> dict[str, str]:
    """Bucket value -> sub-folder of a folder written with ``partition_by``."""
    fs, p = _fs(spark, f"{path}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(f"{column}=")}


def replace_buckets(df: DataFrame, path: str, base: Snapshot, bucket: str, **tags) -> list[dict]:
    """Write ``df`` by its column ``bucket`` and return the live folders with those buckets (of the same tags) replaced, unpublished."""
    spark = df.sparkSession
    folder = write_folder(df.repartition(bucket), path, "bucket", bucket)
    new = _bucketed(spark, path, folder, bucket)
    same = lambda f: all(f.get(k) == v for k, v in tags.items())
    kept = [f for f in base.folders if not (same(f) and f.get("bucket") in new)]
    return kept + [{"folder": at, "bucket": b, **tags} for b, at in sorted(new.items())]


def merge_keyed(df: DataFrame, path: str, keys: list[str], order: list[str], bucket, attempts: int = 5) -> Snapshot:
    """Insert ``df`` into a table that holds one row per key, the newest by ``order``.

    ``bucket`` (a column of strings that depends on the key alone) says where a key lives. Buckets that ``df`` touches are read, merged
    and written anew; all others stay as they are. Readers see either state whole.
    """
    from aerolith.operators.latest import latest_per_key

    spark = df.sparkSession
    schema = df.schema
    rows = latest_per_key(df, keys, order)
    touched = {r[0] for r in rows.select(bucket.cast("string")).distinct().collect()}  # as many as buckets
    for _ in range(attempts):
        base = snapshot(spark, path)
        old = [f"{path}/{f['folder']}" for f in base.folders if f.get("bucket") in touched]
        both = rows.unionByName(spark.read.schema(schema).parquet(*old)) if old else rows
        merged = latest_per_key(both, keys, order).withColumn("_bucket", bucket.cast("string"))
        try:
            return commit(spark, path, base, replace_buckets(merged, path, base, "_bucket"))
        except Conflict:
            continue
    raise Conflict(path)


def compact(spark: SparkSession, path: str, schema, reduce: Callable[[DataFrame], DataFrame], keep: Callable[[dict], bool] = lambda f: False) -> Snapshot:
    """Replace the live folders (but those that ``keep`` names) by one with ``reduce`` of their rows. Folders appended meanwhile stay."""
    base = snapshot(spark, path)
    old = [f["folder"] for f in base.folders if not keep(f)]
    if len(old) < 2:
        return base
    folder = write_folder(reduce(spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in old])), path, "compact")
    upto = max([f[k] for f in base.folders if f["folder"] in old for k in ("batch", "upto") if k in f], default=-1)

    def swap(s: Snapshot):
        live = {f["folder"] for f in s.folders}
        if not live.issuperset(old):  # somebody else compacted
            return None
        return [{"folder": folder, "upto": upto}] + [f for f in s.folders if f["folder"] not in old]

    return update(spark, path, swap)


def has_batch(state: Snapshot, batch: int) -> bool:
    """Whether a streaming batch is in the table, by itself or compacted (batches of a query follow each other)."""
    return any(f.get("batch") == batch or f.get("upto", -1) >= batch for f in state.folders)


def append_batch(df: DataFrame, path: str, batch: int) -> Snapshot:
    """Publish a streaming batch once: a repeat of the batch changes nothing."""
    spark = df.sparkSession
    state = snapshot(spark, path)
    if has_batch(state, batch):
        return state
    folder = write_folder(df, path, f"batch{batch}")
    return update(spark, path, lambda s: None if has_batch(s, batch) else [*s.folders, {"folder": folder, "batch": batch}])


def bucket_of_day(ts: str = "timestamp"):
    """A bucket per day, for tables whose key holds the time: an insert of recent rows touches recent buckets."""
    return F.coalesce(F.date_format(F.col(ts), "yyyy-MM-dd"), F.lit("none"))
