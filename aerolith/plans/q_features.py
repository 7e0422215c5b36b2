"""Registered queries: buckets, lag/rolling/target features, latest rows (AG1, WN1-WN5, DQ6, DQ13, DQ15, IN6, AG20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import aqi as A
from aerolith.operators import features as FE
from aerolith.operators import latest as L
from aerolith.plans import oracle as O
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}


def bucket_3h_mean(spark, sf):
    return FE.bucket_mean(FX.scored(spark, sf), key="city", ts="timestamp", hours=3,
                          columns=["pm2_5", "pm10", "temperature", "us_aqi"], digits=6)


SQL["bucket_3h_mean"] = O.with_views(["scored"], """
SELECT city, time_bucket(INTERVAL 3 HOUR, "timestamp") AS "timestamp",
  round(avg(pm2_5), 6) AS pm2_5, round(avg(pm10), 6) AS pm10, round(avg(temperature), 6) AS temperature,
  round_even(avg(us_aqi), 0) AS us_aqi, count(*) AS n_obs
FROM scored WHERE city IS NOT NULL GROUP BY ALL""")


def bucket_3h_station(spark, sf):
    """AG1 keyed by the sparse station entity (many keys)."""
    return FE.bucket_mean(FX.scored(spark, sf), key="station_id", ts="timestamp", hours=3,
                          columns=["pm2_5", "us_aqi"], digits=6)


SQL["bucket_3h_station"] = O.with_views(["scored"], """
SELECT station_id, time_bucket(INTERVAL 3 HOUR, "timestamp") AS "timestamp",
  round(avg(pm2_5), 6) AS pm2_5, round_even(avg(us_aqi), 0) AS us_aqi, count(*) AS n_obs
FROM scored WHERE station_id IS NOT NULL GROUP BY ALL""")


def series_hourly(spark, sf):
    return FX.series(spark, sf)


SQL["series_hourly"] = O.with_views(["series"], "SELECT * FROM series")


def lag_features(spark, sf):
    s = FX.series(spark, sf)
    return s.select("city", "timestamp", "us_aqi", *[c.alias(n) for n, c in FE.lag_columns("us_aqi").items()])


SQL["lag_features"] = O.with_views(["feats"], """
SELECT city, "timestamp", us_aqi, aqi_lag_1, aqi_lag_3, aqi_lag_6, aqi_lag_24 FROM feats""")


def rolling_features(spark, sf):
    s = FX.series(spark, sf)
    return s.select("city", "timestamp", "us_aqi", *[c.alias(n) for n, c in FE.rolling_columns("us_aqi").items()])


SQL["rolling_features"] = O.with_views(["feats"], """
SELECT city, "timestamp", us_aqi, aqi_roll_3, aqi_roll_6, aqi_roll_24 FROM feats""")


def target_lead(spark, sf):
    s = FE.add_target(FX.series(spark, sf))
    return s.select("city", "timestamp", "us_aqi", "target_aqi")


SQL["target_lead"] = O.with_views(["feats"], 'SELECT city, "timestamp", us_aqi, target_aqi FROM feats')


def feature_table(spark, sf):
    """Full feature rows (calendar + history + target), NULLs kept."""
    return FX.feats(spark, sf)


SQL["feature_table"] = O.with_views(["feats"], "SELECT * FROM feats")


def training_table(spark, sf):
    """DQ6: feature rows with any NULL dropped (the supervised training set)."""
    return FE.drop_incomplete(FX.feats(spark, sf))


SQL["training_table"] = O.with_views(["feats"], """
SELECT * FROM feats WHERE aqi_lag_1 IS NOT NULL AND aqi_lag_3 IS NOT NULL AND aqi_lag_6 IS NOT NULL
  AND aqi_lag_24 IS NOT NULL AND aqi_roll_3 IS NOT NULL AND aqi_roll_6 IS NOT NULL
  AND aqi_roll_24 IS NOT NULL AND target_aqi IS NOT NULL AND us_aqi IS NOT NULL""")


def model_ready(spark, sf):
    f = FX.feats(spark, sf)
    return f.select("city", "timestamp", FE.model_ready_flag().alias("model_ready"))


SQL["model_ready"] = O.with_views(["feats"], """
SELECT city, "timestamp", CAST(aqi_lag_1 IS NOT NULL AND aqi_lag_3 IS NOT NULL AND aqi_lag_6 IS NOT NULL
  AND aqi_lag_24 IS NOT NULL AND aqi_roll_3 IS NOT NULL AND aqi_roll_6 IS NOT NULL
  AND aqi_roll_24 IS NOT NULL AS BIGINT) AS model_ready FROM feats""")


def sequences_24(spark, sf):
    s = FE.sequences(FX.series(spark, sf), length=24)
    return s.select("city", "timestamp", "history", "label")


SQL["sequences_24"] = O.with_views(["series"], """
SELECT city, "timestamp", history, label FROM (
  SELECT city, "timestamp", us_aqi AS label,
    list(us_aqi) OVER (PARTITION BY city ORDER BY "timestamp" ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS history
  FROM series) WHERE len(history) = 24""")


def latest_per_entity(spark, sf):
    return L.latest_per_key(FX.scored(spark, sf), key="city", order=["timestamp", "obs_id"])


SQL["latest_per_entity"] = O.with_views(["scored"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC, obs_id DESC) AS rn
  FROM scored WHERE city IS NOT NULL) WHERE rn = 1""")


def latest_per_station(spark, sf):
    return L.latest_per_key(FX.scored(spark, sf).select("station_id", "timestamp", "obs_id", "us_aqi"),
                            key="station_id", order=["timestamp", "obs_id"])


SQL["latest_per_station"] = O.with_views(["scored"], """
SELECT station_id, "timestamp", obs_id, us_aqi FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY "timestamp" DESC, obs_id DESC) AS rn
  FROM scored WHERE station_id IS NOT NULL) WHERE rn = 1""")


def current_conditions(spark, sf):
    """IN6 + DQ15: latest row per entity of the feature table with labels and readiness."""
    latest = L.latest_per_key(FX.feats(spark, sf), key="city", order=["timestamp"])
    base_cols = ["us_aqi", "pm2_5", "pm10", "temperature", "hour", "day_of_week", "season"]
    return latest.select(
        "city", "timestamp", "us_aqi",
        A.aqi_category("us_aqi").alias("aqi_category"),
        A.alert_level("us_aqi").alias("alert_level"),
        A.health_guidance("us_aqi", "scoring").alias("health_guidance"),
        FE.model_ready_flag(base_cols).alias("latest_complete"),
        FE.model_ready_flag().alias("model_ready"),
    )


SQL["current_conditions"] = O.with_views(["feats"], f"""
SELECT city, "timestamp", us_aqi, {O.category_sql('us_aqi')} AS aqi_category, {O.alert_sql('us_aqi')} AS alert_level,
  {O.guidance_sql('us_aqi')} AS health_guidance,
  CAST(us_aqi IS NOT NULL AND pm2_5 IS NOT NULL AND pm10 IS NOT NULL AND temperature IS NOT NULL AND hour IS NOT NULL
       AND day_of_week IS NOT NULL AND season IS NOT NULL AS BIGINT) AS latest_complete,
  CAST(aqi_lag_1 IS NOT NULL AND aqi_lag_3 IS NOT NULL AND aqi_lag_6 IS NOT NULL AND aqi_lag_24 IS NOT NULL
       AND aqi_roll_3 IS NOT NULL AND aqi_roll_6 IS NOT NULL AND aqi_roll_24 IS NOT NULL AS BIGINT) AS model_ready
FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC) AS rn FROM feats) WHERE rn = 1""")


def alert_summary(spark, sf):
    """AG20: snapshot over the latest row of every entity."""
    latest = L.latest_per_key(FX.scored(spark, sf), key="city", order=["timestamp", "obs_id"])
    lab = latest.withColumn("alert_level", A.alert_level("us_aqi"))
    return lab.agg(
        F.count(F.lit(1)).alias("entities"),
        F.count_if(F.col("alert_level").isin("Warning", "High Alert", "Emergency")).alias("alert_entities"),
        F.round(F.avg("us_aqi"), 6).alias("mean_aqi"),
        F.max("us_aqi").alias("max_aqi"),
        F.max_by("city", F.struct("us_aqi", "city")).alias("worst_entity"),
        F.min_by("city", F.struct("us_aqi", "city")).alias("best_entity"),
    )


SQL["alert_summary"] = O.with_views(["scored"], f"""
SELECT count(*) AS entities,
  count(*) FILTER (WHERE alert_level IN ('Warning', 'High Alert', 'Emergency')) AS alert_entities,
  round(avg(us_aqi), 6) AS mean_aqi, max(us_aqi) AS max_aqi,
  arg_max(city, (us_aqi, city)) AS worst_entity, arg_min(city, (us_aqi, city)) AS best_entity
FROM (SELECT *, {O.alert_sql('us_aqi')} AS alert_level FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC, obs_id DESC) AS rn FROM scored WHERE city IS NOT NULL)
  WHERE rn = 1)""")

QUERIES.update({
    "bucket_3h_mean": bucket_3h_mean, "bucket_3h_station": bucket_3h_station, "series_hourly": series_hourly,
    "lag_features": lag_features, "rolling_features": rolling_features, "target_lead": target_lead,
    "feature_table": feature_table, "training_table": training_table, "model_ready": model_ready,
    "sequences_24": sequences_24, "latest_per_entity": latest_per_entity, "latest_per_station": latest_per_station,
    "current_conditions": current_conditions, "alert_summary": alert_summary,
})
