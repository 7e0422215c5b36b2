"""Registered queries: scalar functions (SC1-SC10, SC13, SC18, SC19)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import aqi as A
from aerolith.functions.calendar import calendar_columns, floor_hours, slot_label
from aerolith.plans import oracle as O
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}


def aqi_sub_index(spark, sf):
    return FX.scored(spark, sf).select("obs_id", "pm2_5", "pm10", "pm25_index", "pm10_index")


SQL["aqi_sub_index"] = O.with_views(["scored"], "SELECT obs_id, pm2_5, pm10, pm25_index, pm10_index FROM scored")


def us_aqi(spark, sf):
    return FX.scored(spark, sf).select("obs_id", "city", "us_aqi")


SQL["us_aqi"] = O.with_views(["scored"], "SELECT obs_id, city, us_aqi FROM scored")


def aqi_bands(spark, sf):
    s = FX.scored(spark, sf)
    return s.select(
        "obs_id", "us_aqi",
        A.aqi_category("us_aqi").alias("aqi_category"),
        A.alert_level("us_aqi").alias("alert_level"),
        A.health_guidance("us_aqi", "scoring").alias("guidance_scoring"),
        A.health_guidance("us_aqi", "forecast").alias("guidance_forecast"),
        A.health_guidance("us_aqi", "dashboard").alias("guidance_dashboard"),
        A.aqi_color("us_aqi").alias("color"),
        A.aqi_card_class("us_aqi").alias("card_class"),
        A.activity_recommendation("us_aqi")["level"].alias("activity_level"),
        # SC19: banded cut of the pollutant concentration itself (same bands)
        A.aqi_category("pm2_5").alias("pm25_band"),
    )


SQL["aqi_bands"] = O.with_views(["scored"], f"""
SELECT obs_id, us_aqi, {O.category_sql('us_aqi')} AS aqi_category, {O.alert_sql('us_aqi')} AS alert_level,
  {O.guidance_sql('us_aqi', 'scoring')} AS guidance_scoring, {O.guidance_sql('us_aqi', 'forecast')} AS guidance_forecast,
  {O.guidance_sql('us_aqi', 'dashboard')} AS guidance_dashboard, {O.color_sql('us_aqi')} AS color,
  {O.card_sql('us_aqi')} AS card_class, {O.activity_level_sql('us_aqi')} AS activity_level,
  {O.category_sql('pm2_5')} AS pm25_band
FROM scored""")


def calendar_features(spark, sf):
    o = FX.obs(spark, sf)
    return o.select("obs_id", *[c.alias(n) for n, c in calendar_columns("timestamp").items()],
                    slot_label("timestamp").alias("slot_label"))


SQL["calendar_features"] = O.with_views(["obs"], f"""
SELECT obs_id, {O.calendar_sql()}, strftime("timestamp", '%a %d %b, %I:%M %p') AS slot_label FROM obs""")


def floor_3h(spark, sf):
    o = FX.obs(spark, sf)
    return o.select("obs_id", floor_hours("timestamp", 3).alias("bucket_timestamp"),
                    F.date_trunc("hour", "timestamp").alias("hour_timestamp"))


SQL["floor_3h"] = O.with_views(["obs"], """
SELECT obs_id, time_bucket(INTERVAL 3 HOUR, "timestamp") AS bucket_timestamp,
       date_trunc('hour', "timestamp") AS hour_timestamp FROM obs""")


def clip_round(spark, sf):
    """SC13 on a derived raw model output (pm10 scaled so values leave [0, 500])."""
    o = FX.obs(spark, sf)
    raw = F.col("pm10") * F.lit(1.5) - F.lit(40.0)
    return o.select("obs_id", A.clip_prediction(raw).alias("predicted_aqi"))


SQL["clip_round"] = O.with_views(["obs"], """
SELECT obs_id, round_even(least(greatest(pm10 * 1.5::DOUBLE - 40.0::DOUBLE, 0.0::DOUBLE), 500.0::DOUBLE), 2) AS predicted_aqi FROM obs""")

QUERIES.update({
    "aqi_sub_index": aqi_sub_index, "us_aqi": us_aqi, "aqi_bands": aqi_bands,
    "calendar_features": calendar_features, "floor_3h": floor_3h, "clip_round": clip_round,
})
