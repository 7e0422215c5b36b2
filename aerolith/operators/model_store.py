"""Stored models: fits kept by what they were fitted on, and a registry of versions (ML6, ML10, RG1, RG3, MO7).

Both are published tables (``sources.manifest``) whose rows name pipelines saved with MLlib's writer. A fit is looked up by the
digest of its training rows and its parameters, so queries, sessions and retries share one. A version is registered in
one step: its row and its number appear together, and of two registrations at once each gets a number of its own.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import registry as R
from aerolith.session import ensure_checkpoint_dir
from aerolith.sources import manifest as M


def default_store(spark: SparkSession) -> str:
    """The fit store on shared storage: the same folder for every session of a checkpoint folder."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/aerolith-fits"


def data_digest(df: DataFrame) -> str:
    """A digest of the rows, whatever their order or partitions: number, sum and exclusive-or of their hashes."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return hashlib.sha256(f"{sorted(df.dtypes)}|{r['n']}|{r['s']}|{r['x']}".encode()).hexdigest()


@dataclass
class Fit:
    """A stored fit: the model, how long it took, and whether it was there already."""

    model: PipelineModel
    seconds: float
    found: bool


def flat(model: PipelineModel) -> PipelineModel:
    """``model`` with the stages of pipelines inside it as its own, so that MLlib's writer saves it."""
    return PipelineModel([x for stage in model.stages for x in (stage.stages if isinstance(stage, PipelineModel) else [stage])])


def fit_once(pipeline: Pipeline, train: DataFrame, what: dict, store: str | None = None, digest: str | None = None) -> Fit:
    """The fit of ``pipeline`` on ``train``, from the store if the same rows were fitted with the same ``what`` (a JSON-able description)."""
    spark = train.sparkSession
    store = store or default_store(spark)
    key = hashlib.sha256(json.dumps([digest or data_digest(train), what], sort_keys=True).encode()).hexdigest()
    found = M.snapshot(spark, store).tagged(key=key)
    if found:
        return Fit(PipelineModel.load(f"{store}/{found[0]['folder']}"), found[0]["seconds"], True)
    start = time.perf_counter()
    model = flat(pipeline.fit(train))
    seconds = round(time.perf_counter() - start, 3)
    folder = f"data/fit-{uuid.uuid4().hex[:12]}"
    model.write().save(f"{store}/{folder}")
    M.update(spark, store, lambda s: None if s.tagged(key=key) else [*s.folders, {"folder": folder, "key": key, "seconds": seconds}])
    return Fit(model, seconds, False)


REGISTRY_ROWS = T.StructType([*R.REGISTRY_SCHEMA.fields, T.StructField("path", T.StringType())])


def register(spark: SparkSession, path: str, name: str, model: PipelineModel, metrics: dict[str, float], dataset_version: str) -> str:
    """RG1: store a fitted pipeline as the next version of ``name``; the version.

    The pipeline is saved first, where nobody looks; then the row with the next free number is published. If another
    registration takes that number meanwhile, the row is written again with the next.
    """
    saved = f"models/{name}-{uuid.uuid4().hex[:12]}"
    model.write().save(f"{path}/{saved}")
    named = F.create_map(*[F.lit(x) for k, v in metrics.items() for x in (k, float(v))])
    got = {}

    def add(state: M.Snapshot):
        number = max([f["number"] for f in state.tagged(model=name)], default=0) + 1
        got["version"] = f"v{number}"
        row = spark.range(1).select(
            F.lit(name).alias("model"), F.lit(got["version"]).alias("version"), F.lit(number).cast("long").alias("version_no"),
            F.lit(len(state.folders) + 1).cast("long").alias("registered_seq"), F.lit(dataset_version).alias("dataset_version"),
            R.normalize_metrics(named).alias("metrics"), F.lit(saved).alias("path"))
        return [*state.folders, {"folder": M.write_folder(row, path, "version"), "model": name, "number": number}]

    M.update(spark, path, add)
    return got["version"]


ROLLBACKS = "model string, version_no long, after long"


def roll_back(spark: SparkSession, path: str, name: str, version_no: int) -> None:
    """RG4: put a registered version back into production; versions registered later compete with it."""
    def add(state: M.Snapshot):
        after = max([f["number"] for f in state.tagged(model=name)], default=0)
        row = spark.createDataFrame([(name, version_no, after)], ROLLBACKS)
        return [*state.folders, {"folder": M.write_folder(row, path, "rollback"), "kind": "rollback"}]

    M.update(spark, path, add)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """RG5: every registered version with its status, from a replay of the stored rows."""
    state = M.snapshot(spark, path)
    rows = M.read(spark, path, REGISTRY_ROWS, M.Snapshot(state.version, [f for f in state.folders if f.get("kind") != "rollback"]))
    back = M.read(spark, path, ROLLBACKS, state, kind="rollback")
    return R.registry_status(rows.withColumn("rmse", F.col("metrics.RMSE")), rollback=back)


@dataclass
class Production:
    """The version in production: its registry row and its pipeline."""

    row: dict
    model: PipelineModel


def production(spark: SparkSession, path: str, name: str | None = None) -> Production:
    """RG3: the version in production (of ``name``, else of the model registered first), loaded from the store."""
    row = R.resolve_production(versions(spark, path), preferred=name).first()
    if row is None or row["path"] is None:
        raise LookupError(f"no version of {name or 'any model'} is registered in {path}")
    return Production(row.asDict(recursive=True), PipelineModel.load(f"{path}/{row['path']}"))


def score(prod: Production, df: DataFrame, y_hat: str = "y_hat") -> DataFrame:
    """MO7: ``df`` with the prediction of the version in production."""
    return prod.model.transform(df).select(*df.columns, F.col("prediction").alias(y_hat))
