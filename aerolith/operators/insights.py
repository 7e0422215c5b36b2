"""Forecast insight tables (AG12, AG13, IN1-IN5, IN7, SO5, SO6).

Everything groups the forecast by entity (24 rows per entity) or ranks a
table with one row per entity, so each group is bounded by the forecast
horizon; ties are broken explicitly (first step / earliest time wins).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.aqi import activity_recommendation, aqi_category
from aerolith.functions.calendar import slot_label
from aerolith.operators.ranking import with_global_position


def forecast_summary(fc: DataFrame, key: str = "city") -> DataFrame:
    """AG12/IN5: average, peak and low forecast AQI per entity."""
    return fc.groupBy(key).agg(F.bround(F.avg("predicted_aqi"), 2).alias("avg_aqi"),
                               F.max("predicted_aqi").alias("max_aqi"), F.min("predicted_aqi").alias("min_aqi"),
                               F.count(F.lit(1)).alias("points"))


def daily_forecast(fc: DataFrame, key: str = "city") -> DataFrame:
    """AG13: daily average / min / max forecast per entity."""
    return fc.groupBy(key, F.date_format("timestamp", "yyyy-MM-dd").alias("date")).agg(
        F.bround(F.avg("predicted_aqi"), 2).alias("avg_aqi"), F.min("predicted_aqi").alias("min_aqi"),
        F.max("predicted_aqi").alias("max_aqi"))


def nearest_horizon(fc: DataFrame, targets=(24, 48, 72), key: str = "city") -> DataFrame:
    """IN1: forecast value at the step nearest to each target horizon (earliest step wins ties)."""
    return fc.groupBy(key).agg(*[
        F.min_by("predicted_aqi", F.struct(F.abs(F.col("hours_ahead") - t), F.col("hours_ahead"))).alias(f"aqi_{t}h")
        for t in targets])


def _whole(c):
    return F.bround(c, 0).cast("bigint").cast("string")


def smart_alerts(fc: DataFrame, key: str = "city") -> DataFrame:
    """IN2: peak alert (severity, title, message) and best outdoor window per entity."""
    agg = fc.groupBy(key).agg(
        F.max_by("timestamp", F.struct(F.col("predicted_aqi"), -F.col("forecast_step"))).alias("peak_ts"),
        F.max("predicted_aqi").alias("peak_aqi"),
        F.min_by("timestamp", F.struct(F.col("predicted_aqi"), F.col("forecast_step"))).alias("min_ts"),
        F.min("predicted_aqi").alias("min_aqi"))
    peak = F.col("peak_aqi")
    # Alert texts.
    reach = F.concat(F.lit("AQI may reach "), _whole(peak), F.lit(" around "), slot_label("peak_ts"))
    return agg.select(
        key, "peak_aqi",
        F.when(peak > 150, "danger").when(peak > 100, "warning").otherwise("success").alias("peak_severity"),
        F.when(peak > 150, "High AQI Alert").when(peak > 100, "Sensitive Group Alert")
        .otherwise("Air Quality Outlook").alias("peak_title"),
        F.when(peak > 150, F.concat(reach, F.lit(". Plan important outdoor activities for a cleaner period.")))
        .when(peak > 100, F.concat(reach, F.lit(". Sensitive people should reduce prolonged outdoor exposure.")))
        .otherwise(F.lit("No unhealthy AQI period is predicted in the current 72-hour forecast.")).alias("peak_message"),
        "min_aqi",
        F.when(F.col("min_aqi") <= 100, "success").otherwise("warning").alias("best_severity"),
        F.concat(F.lit("The cleanest forecast point is "), slot_label("min_ts"), F.lit(" with AQI near "),
                 _whole(F.col("min_aqi")), F.lit(" ("), aqi_category("min_aqi"), F.lit(").")).alias("best_message"),
    )


def activity_windows(fc: DataFrame, limit: int = 8, key: str = "city") -> DataFrame:
    """IN3/SO5: the ``limit`` cleanest forecast slots per entity (top-k is the feature here)."""
    w = Window.partitionBy(key).orderBy("predicted_aqi", "timestamp")
    ranked = fc.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= limit)
    return ranked.select(key, "rank", slot_label("timestamp").alias("recommended_time"),
                         F.bround("predicted_aqi", 0).cast("bigint").alias("forecast_aqi"),
                         aqi_category("predicted_aqi").alias("aqi_category"),
                         activity_recommendation("predicted_aqi")["level"].alias("activity_advice"))


def entity_comparison(fc: DataFrame, key: str = "city") -> DataFrame:
    """IN4: next, 24 h avg, 72 h avg, 72 h peak, category; ranked by 24 h average (1 dp)."""
    c = fc.groupBy(key).agg(
        F.min_by("predicted_aqi", "forecast_step").alias("next_aqi"),
        F.avg(F.when(F.col("hours_ahead") <= 24, F.col("predicted_aqi"))).alias("avg_24h"),
        F.avg("predicted_aqi").alias("avg_72h"), F.max("predicted_aqi").alias("peak_72h"),
        F.any_value("data_source").alias("data_source"))
    # positions over ranges of the order, however many entities there are
    placed = with_global_position(c, ["avg_24h", key], pos_col="_rank")
    return placed.select((F.col("_rank") + 1).cast("bigint").alias("rank"), key,
                    *[F.bround(x, 1).alias(x) for x in ("next_aqi", "avg_24h", "avg_72h", "peak_72h")],
                    aqi_category("next_aqi").alias("aqi_category"), "data_source")


def serving_health(fc: DataFrame, realtime: DataFrame, historical: DataFrame, key: str = "city") -> DataFrame:
    """IN7: served row and entity counts (one row, from scalar subqueries)."""
    ents = realtime.select(key).unionByName(historical.select(key)).distinct()
    return fc.agg(F.count(F.lit(1)).alias("forecast_rows"), F.count_distinct(key).alias("forecast_entities")) \
        .select("forecast_rows", "forecast_entities",
                realtime.agg(F.count(F.lit(1))).scalar().alias("realtime_rows"),
                historical.agg(F.count(F.lit(1))).scalar().alias("historical_rows"),
                ents.agg(F.count(F.lit(1))).scalar().alias("available_entities"))
