"""Model registry as an append-only table (RG1-RG5, WN11, SC15, AG19).

The reference keeps a nested JSON document (model -> versions[] with
metrics and status). Here every registration is one row of a flat table, and so
is every rollback; status is *derived* by replaying both: a version is promoted
when its RMSE is strictly below that of the version then in production, the
latest promoted or rolled-back-to version is ``production``, earlier ones
``archived``, the rest ``candidate``. Registry tables
are metadata (one row per trained model), so per-model windows are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric names and the keys accepted for each (first present wins, default 0).
METRIC_ALIASES = {
    "MAE": ["MAE", "mae"],
    "RMSE": ["RMSE", "rmse"],
    "R2": ["R2", "r2"],
    "MAPE": ["MAPE", "MAPE (%)", "mape"],
}

REGISTRY_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("version_no", T.LongType()),
    T.StructField("registered_seq", T.LongType()),
    T.StructField("dataset_version", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(m, T.DoubleType()) for m in METRIC_ALIASES])),
])


def normalize_metrics(metrics: Column | str) -> Column:
    """RG1: map<string, double> of raw metric names -> struct(MAE, RMSE, R2, MAPE)."""
    m = F.col(metrics) if isinstance(metrics, str) else metrics
    return F.struct(*[
        F.coalesce(*[F.element_at(m, F.lit(k)) for k in keys], F.lit(0.0)).cast("double").alias(name)
        for name, keys in METRIC_ALIASES.items()])


def version_number(version: Column | str) -> Column:
    """SC15: 'v12' / 'V12' / '12' -> 12; anything else -> NULL."""
    v = F.trim(F.col(version) if isinstance(version, str) else version)
    digits = F.regexp_extract(v, r"^[vV]?([0-9]+)$", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def next_version(registry: DataFrame, model: str = "model", version: str = "version") -> DataFrame:
    """SC15: next 'vN' per model (max valid number + 1; 'v1' when none is valid)."""
    return registry.groupBy(model).agg(
        F.concat(F.lit("v"), (F.coalesce(F.max(version_number(version)), F.lit(0)) + 1).cast("string"))
        .alias("next_version"))


def _replay(runs: DataFrame, model: str, order: str, rmse: str, rollback: DataFrame | None) -> DataFrame:
    """Registrations and rollbacks in sequence: each run with its production RMSE before, promotion and final version.

    A rollback starts a new segment of the model's events, headed by its target's RMSE. Inside a
    segment the RMSE in production is the running minimum, so windows are enough.
    """
    events = runs.select(F.col(model).alias("_model"), F.col(order).cast("long").alias("_seq"), F.lit(0).alias("_kind"),
                         F.col(order).cast("long").alias("_target"), F.col(rmse).alias("_rmse"),
                         F.struct(*[F.col(c) for c in runs.columns]).alias("_row"))
    if rollback is not None:
        after = F.col("after").cast("long") if "after" in rollback.columns else F.lit(2**63 - 1)
        back = rollback.select(F.col(model).alias("_model"), F.col(order).cast("long").alias("_target"), after.alias("_seq"))
        targets = events.select("_model", "_target", "_rmse")
        back = back.where("_target <= _seq").join(targets, ["_model", "_target"]).withColumn("_kind", F.lit(1))
        events = events.unionByName(back, allowMissingColumns=True)
    seq = Window.partitionBy("_model").orderBy("_seq", "_kind", "_target")
    events = events.withColumn("_segment", F.sum("_kind").over(seq))
    before = (Window.partitionBy("_model", "_segment").orderBy("_seq", "_kind", "_target")
              .rowsBetween(Window.unboundedPreceding, -1))
    events = events.withColumn("_prev", F.min("_rmse").over(before))
    events = events.withColumn("_won", (F.col("_kind") == 1) | F.col("_prev").isNull() | (F.col("_rmse") < F.col("_prev")))
    final = F.max_by("_target", F.when(F.col("_won"), F.struct("_seq", "_kind", "_target")))
    events = events.withColumns({"_prod": final.over(Window.partitionBy("_model")),
                                 "_back": F.max("_kind").over(Window.partitionBy("_model", "_target"))})
    return events.where("_kind = 0")


def champion_history(runs: DataFrame, model: str = "model", order: str = "version_no",
                     rmse: str = "rmse", rollback: DataFrame | None = None) -> DataFrame:
    """WN11/RG2: RMSE in production before each version; promoted when strictly lower (or first)."""
    return _replay(runs, model, order, rmse, rollback).select(
        *[F.col(f"_row.{c}").alias(c) for c in runs.columns], F.col("_prev").alias("previous_best_rmse"), F.col("_won").alias("promoted"))


def registry_status(history: DataFrame, model: str = "model", order: str = "version_no",
                    rollback: DataFrame | None = None, rmse: str = "rmse") -> DataFrame:
    """RG2/RG4: derive production / archived / candidate.

    ``rollback`` holds one row per rollback: model, the version (``order``) put back into
    production, and ``after``, the latest version registered at that time (without the column:
    all). Versions registered later compete with the version put back. Rollbacks to versions
    that are not registered by then are ignored; of several after the same version the
    highest target counts last.
    """
    runs = history.drop("previous_best_rmse", "promoted")
    status = (F.when(F.col("_target") == F.col("_prod"), F.lit("production"))
              .when(F.col("_won") | (F.col("_back") == 1), F.lit("archived"))
              .otherwise(F.lit("candidate")))
    return _replay(runs, model, order, rmse, rollback).select(
        *[F.col(f"_row.{c}").alias(c) for c in runs.columns], F.col("_prev").alias("previous_best_rmse"),
        F.col("_won").alias("promoted"), status.alias("status"))


def production_versions(status: DataFrame, model: str = "model") -> DataFrame:
    """RG3: the production row of every model."""
    return status.filter(F.col("status") == "production")


def resolve_production(status: DataFrame, model: str = "model", order_col: str = "registered_seq",
                       preferred: str | None = None) -> DataFrame:
    """RG3: one production model for serving: ``preferred`` if given, else the earliest registered one."""
    prod = production_versions(status, model)
    if preferred is not None:
        prod = prod.filter(F.col(model) == preferred)
    return prod.agg(F.min_by(F.struct(*[F.col(c) for c in prod.columns]), F.col(order_col)).alias("_r")).select("_r.*")


def dataset_version(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """AG19: 'yyyy-MM-dd_to_yyyy-MM-dd' from the time range (or 'unknown' without times)."""
    if ts not in df.columns:
        return df.sparkSession.createDataFrame([("unknown",)], "dataset_version string")
    return df.agg(F.concat_ws("_to_", F.date_format(F.min(ts), "yyyy-MM-dd"),
                              F.date_format(F.max(ts), "yyyy-MM-dd")).alias("dataset_version"))
