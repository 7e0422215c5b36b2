"""Registered queries: attributions (EX1-EX6, SC17, SO7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import attribution as A
from aerolith.operators import features as FE
from aerolith.operators import forecast as FC
from aerolith.operators import ml as ML
from aerolith.plans import oracle as O
from aerolith.plans.q_monitoring import TRAIN_SQL, split_table
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}
KEYS = ["city", "timestamp"]
RAW = ML.CATEGORICAL_FEATURES + ML.NUMERIC_FEATURES


def _explained(spark, sf):
    """Ridge pipeline (one-hot + numeric) fitted on the reference slice; the whole current slice explained."""
    t = split_table(spark, sf)
    train = t.filter(F.col("split") == "reference")
    fitted, _ = ML.train_models(train, [ML.ModelSpec("Ridge", "ridge")])
    return A.linear_attributions(fitted["Ridge"], t.filter(F.col("split") == "current"), train, KEYS, RAW)


def sample_rows(spark, sf):
    """SO7: deterministic 2 000-row sample of the training table (sampling is the feature)."""
    return A.sample_rows(FE.drop_incomplete(FX.feats(spark, sf)), KEYS).select(*KEYS, "us_aqi", "target_aqi")


SQL["sample_rows"] = O.with_views(["feats"], f"""
SELECT city, "timestamp", us_aqi, target_aqi FROM train
ORDER BY md5(concat_ws('|', city, strftime("timestamp", '%Y-%m-%d %H:%M:%S'), '{A.SAMPLE_SEED}')), city, "timestamp" LIMIT {A.SAMPLE_SIZE}""", [("train", TRAIN_SQL)])


def feature_labels(spark, sf):
    """SC17: encoded slots (numeric features, and one per city, weekday and season of the table) with raw feature and label."""
    t = FX.feats(spark, sf)
    slots = t.select(F.explode(F.concat(
        F.array(*[F.lit(c) for c in [*ML.NUMERIC_FEATURES, "unknown_measure"]]),
        F.array(*[F.concat_ws("_", F.lit(c), F.col(c)) for c in ML.CATEGORICAL_FEATURES]))).alias("slot")).distinct()
    return slots.select("slot", A.raw_feature("slot", RAW).alias("raw_feature")).withColumn("label", A.feature_label("raw_feature"))


def _case(labels):
    return "CASE raw_feature " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + " WHEN 'unknown_measure' THEN 'Unknown Measure' WHEN 'hour' THEN 'Hour' WHEN 'day' THEN 'Day' WHEN 'month' THEN 'Month' END"


SQL["feature_labels"] = O.with_views(["feats"], f"""
SELECT slot, raw_feature, {_case(A.FEATURE_LABELS)} AS label FROM (
  SELECT c AS slot, c AS raw_feature FROM (SELECT unnest([{', '.join(repr(c) for c in [*ML.NUMERIC_FEATURES, 'unknown_measure'])}]) AS c)
  UNION {' UNION '.join(f"SELECT DISTINCT '{c}_' || {c}, '{c}' FROM feats" for c in ML.CATEGORICAL_FEATURES)})""")


def linear_attribution(spark, sf):
    return _explained(spark, sf)


def global_importance(spark, sf):
    return A.global_importance(A.fold_onehot(_explained(spark, sf), KEYS))


def fold_onehot(spark, sf):
    return A.fold_onehot(_explained(spark, sf), KEYS)


def additivity_check(spark, sf):
    return A.additivity(_explained(spark, sf), KEYS)


def driver_text(spark, sf):
    return A.driver_text(A.fold_onehot(_explained(spark, sf), KEYS), KEYS)


def local_explanation(spark, sf):
    """EX6: attributions of the latest explained row per entity, sorted by |phi|."""
    folded = A.fold_onehot(_explained(spark, sf), KEYS)
    latest = folded.groupBy("city").agg(F.max("timestamp").alias("timestamp"))
    return folded.join(latest, KEYS).orderBy("city", "impact_rank")


def closed_form_attribution(spark, sf):
    """EX1/EX4 for the closed-form forecasting model over the whole training table (SQL-checked)."""
    t = FE.drop_incomplete(FX.feats(spark, sf))
    coef = FC.fit_roll3_linear(t).select(F.struct("alpha", "beta")).scalar()
    mean = t.agg(F.avg("aqi_roll_3")).scalar()
    out = t.select(*KEYS, "aqi_roll_3").withColumn("_c", coef).withColumn("_m", mean)
    phi = F.col("_c.beta") * (F.col("aqi_roll_3") - F.col("_m"))
    base = F.col("_c.alpha") + F.col("_c.beta") * F.col("_m")
    pred = F.col("_c.alpha") + F.col("_c.beta") * F.col("aqi_roll_3")
    return out.select(*KEYS, F.round(phi, 6).alias("phi_aqi_roll_3"), F.round(base, 6).alias("base_value"),
                      F.round(pred, 6).alias("prediction"), (F.abs(base + phi - pred) <= 1e-9).alias("additive"))


SQL["closed_form_attribution"] = O.with_views(["feats"], """
WITH m AS (SELECT round(regr_intercept(target_aqi, aqi_roll_3), 6) AS alpha, round(regr_slope(target_aqi, aqi_roll_3), 6) AS beta,
                  avg(aqi_roll_3) AS mu FROM train)
SELECT city, "timestamp", round(beta * (aqi_roll_3 - mu), 6) AS phi_aqi_roll_3, round(alpha + beta * mu, 6) AS base_value,
  round(alpha + beta * aqi_roll_3, 6) AS prediction,
  abs((alpha + beta * mu) + beta * (aqi_roll_3 - mu) - (alpha + beta * aqi_roll_3)) <= 1e-9 AS additive
FROM train, m""", [("train", TRAIN_SQL)])

QUERIES.update({
    "sample_rows": sample_rows, "feature_labels": feature_labels, "linear_attribution": linear_attribution, "global_importance": global_importance,
    "fold_onehot": fold_onehot, "additivity_check": additivity_check, "driver_text": driver_text,
    "local_explanation": local_explanation, "closed_form_attribution": closed_form_attribution,
})
