"""Registered queries: coercion, schema alignment, profiling, de-duplication (DQ*, PR*, SO1-SO4)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import features as FE
from aerolith.operators import quality as Q
from aerolith.plans import oracle as O
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}

RAW_NUMERIC = ["pm2_5", "pm10", "temperature"]


def coerce_lenient(spark, sf):
    raw = FX.obs_raw(spark, sf)
    return Q.coerce_lenient(raw, "timestamp", RAW_NUMERIC, key="city").select(
        "obs_id", "city", "timestamp", *RAW_NUMERIC)


SQL["coerce_lenient"] = O.with_views(["obs_raw"], """
SELECT obs_id, trim(city) AS city, try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
  TRY_CAST(pm2_5 AS DOUBLE) AS pm2_5, TRY_CAST(pm10 AS DOUBLE) AS pm10, TRY_CAST(temperature AS DOUBLE) AS temperature
FROM obs_raw WHERE try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') IS NOT NULL AND city IS NOT NULL AND trim(city) <> ''""")


def coerce_report(spark, sf):
    return Q.coercion_report(FX.obs_raw(spark, sf), "timestamp", RAW_NUMERIC, key="city")


SQL["coerce_report"] = O.with_views(["obs_raw"], """
SELECT count(*) AS rows,
  count(*) FILTER (WHERE try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') IS NULL) AS invalid_timestamps,
  count(*) FILTER (WHERE city IS NULL) AS null_keys,
  count(*) FILTER (WHERE pm2_5 IS NOT NULL AND TRY_CAST(pm2_5 AS DOUBLE) IS NULL) AS bad_pm2_5,
  count(*) FILTER (WHERE pm10 IS NOT NULL AND TRY_CAST(pm10 AS DOUBLE) IS NULL) AS bad_pm10,
  count(*) FILTER (WHERE temperature IS NOT NULL AND TRY_CAST(temperature AS DOUBLE) IS NULL) AS bad_temperature,
  count(*) FILTER (WHERE try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') IS NULL) = 0 AS strict_ok
FROM obs_raw""")

TARGET_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("pm2_5", T.DoubleType()),
    T.StructField("carbon_monoxide", T.DoubleType()),
    T.StructField("openweather_aqi_index", T.DoubleType()),
    T.StructField("wind_direction", T.DoubleType()),
    T.StructField("precipitation", T.DoubleType()),
])


def schema_align(spark, sf):
    """PR1-PR4: provider-shaped rows -> guarded renames -> defaults -> case-insensitive contract projection."""
    s = FX.scored(spark, sf)
    api = s.select(
        F.col("city").alias("CITY"), F.col("timestamp").alias("Timestamp"),
        F.col("pm2_5").cast("string").alias("PM2_5"),
        (F.col("pm10") / F.lit(10.0)).alias("co"),
        F.col("pm25_index").alias("aqi"),
        F.lit("x").alias("junk"),
    )
    out = Q.align_to_schema(Q.add_missing_columns(Q.standardize_columns(api)), TARGET_SCHEMA)
    return out


SQL["schema_align"] = O.with_views(["scored"], """
SELECT city, "timestamp", TRY_CAST(CAST(pm2_5 AS VARCHAR) AS DOUBLE) AS pm2_5, pm10 / 10.0::DOUBLE AS carbon_monoxide,
  CAST(pm25_index AS DOUBLE) AS openweather_aqi_index, 0.0::DOUBLE AS wind_direction, 0.0::DOUBLE AS precipitation
FROM scored""")


def strict_cast(spark, sf):
    """PR5: per-column count of values that fail the strict contract cast."""
    raw = FX.obs_raw(spark, sf)
    schema = T.StructType([T.StructField("pm2_5", T.DoubleType()), T.StructField("pm10", T.DoubleType()),
                           T.StructField("station_id", T.LongType())])
    return Q.strict_cast_report(raw, schema)


SQL["strict_cast"] = O.with_views(["obs_raw"], """
SELECT count(*) FILTER (WHERE pm2_5 IS NOT NULL AND TRY_CAST(pm2_5 AS DOUBLE) IS NULL) AS bad_pm2_5,
  count(*) FILTER (WHERE pm10 IS NOT NULL AND TRY_CAST(pm10 AS DOUBLE) IS NULL) AS bad_pm10,
  count(*) FILTER (WHERE station_id IS NOT NULL AND TRY_CAST(station_id AS BIGINT) IS NULL) AS bad_station_id
FROM obs_raw""")


def strict_rows(spark, sf):
    """PR5: the strict contract cast itself over all rows whose numbers are well-formed (one bad number would fail the load)."""
    raw = FX.obs_raw(spark, sf).where(F.col("pm2_5") != "n/a")
    schema = T.StructType([T.StructField("obs_id", T.LongType()), T.StructField("PM2_5", T.DoubleType()), T.StructField("pm10", T.DoubleType()),
                           T.StructField("station_id", T.LongType())])
    return Q.strict_cast(raw, schema)


SQL["strict_rows"] = O.with_views(["obs_raw"], """
SELECT obs_id, pm2_5::DOUBLE AS "PM2_5", pm10::DOUBLE AS pm10, station_id::BIGINT AS station_id FROM obs_raw WHERE pm2_5 <> 'n/a'""")


def null_profile(spark, sf):
    raw = FX.obs_raw(spark, sf)
    schema = T.StructType([T.StructField("obs_id", T.LongType()), T.StructField("city", T.StringType()),
                           T.StructField("timestamp", T.TimestampNTZType()),
                           *[T.StructField(c, T.DoubleType()) for c in RAW_NUMERIC]])
    return Q.null_profile(Q.align_to_schema(raw, schema))


SQL["null_profile"] = O.with_views(["obs_raw"], """
WITH t AS (SELECT obs_id, city, TRY_CAST("timestamp" AS TIMESTAMP) AS ts, TRY_CAST(pm2_5 AS DOUBLE) AS pm2_5,
  TRY_CAST(pm10 AS DOUBLE) AS pm10, TRY_CAST(temperature AS DOUBLE) AS temperature FROM obs_raw)
SELECT column_name, nulls, rows FROM (
  SELECT 'obs_id' AS column_name, count(*) FILTER (WHERE obs_id IS NULL) AS nulls, count(*) AS rows FROM t UNION ALL
  SELECT 'city', count(*) FILTER (WHERE city IS NULL), count(*) FROM t UNION ALL
  SELECT 'timestamp', count(*) FILTER (WHERE ts IS NULL), count(*) FROM t UNION ALL
  SELECT 'pm2_5', count(*) FILTER (WHERE pm2_5 IS NULL), count(*) FROM t UNION ALL
  SELECT 'pm10', count(*) FILTER (WHERE pm10 IS NULL), count(*) FROM t UNION ALL
  SELECT 'temperature', count(*) FILTER (WHERE temperature IS NULL), count(*) FROM t)""")


def quality_overview(spark, sf):
    o = FX.obs(spark, sf)
    return Q.duplicate_count(o.unionByName(o.filter(F.col("obs_id") % 10 == 0)))


SQL["quality_overview"] = O.with_views(["obs"], """
WITH u AS (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE obs_id % 10 = 0)
SELECT (SELECT count(*) FROM u) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM u)) AS distinct_rows,
  (SELECT count(*) FROM u) - (SELECT count(*) FROM (SELECT DISTINCT * FROM u)) AS duplicate_rows""")


def feature_availability(spark, sf):
    return Q.feature_availability(FX.feats(spark, sf), FE.HISTORY_FEATURES + ["target_aqi"])


def _avail_sql():
    parts = []
    for f in FE.HISTORY_FEATURES + ["target_aqi"]:
        parts.append(f"SELECT '{f}' AS feature, count({f}) AS available, count(*) - count({f}) AS missing FROM feats")
    return O.with_views(["feats"], "SELECT feature, available, missing, round(available / (available + missing) * 100, 2) AS available_pct FROM ("
                        + " UNION ALL ".join(parts) + ")")


SQL["feature_availability"] = _avail_sql()


def target_check(spark, sf):
    return Q.target_check(FX.feats(spark, sf))


SQL["target_check"] = O.with_views(["feats"], """
SELECT min(target_aqi) AS target_min, max(target_aqi) AS target_max,
  count(*) FILTER (WHERE target_aqi IS NULL) AS target_missing, count(*) AS rows FROM feats""")


def range_check(spark, sf):
    """DQ12: coordinate range flags on derived coordinates."""
    ev = FX.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    coords = ev.select(F.col("event_id").alias("obs_id"), ((k - F.lit(45.0)) * F.lit(2.0)).alias("latitude"),
                       (k * F.lit(3.7) - F.lit(180.0)).alias("longitude"))
    return coords.withColumn("valid_coordinates", Q.range_flags("latitude", "longitude"))


SQL["range_check"] = f"""
SELECT obs_id, latitude, longitude, latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AS valid_coordinates
FROM (SELECT event_id AS obs_id, ({O.K} - 45.0::DOUBLE) * 2.0::DOUBLE AS latitude,
  {O.K} * 3.7::DOUBLE - 180.0::DOUBLE AS longitude FROM events)"""


def history_coverage(spark, sf):
    rt, _ = FX.series_halves(spark, sf)
    return Q.history_coverage(rt, "city", "timestamp", 24.0).withColumn("span_hours", F.round("span_hours", 6))


SQL["history_coverage"] = O.with_views(["series_rt"], """
SELECT city, round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 3.6e9, 6) AS span_hours, count(*) AS rows,
  (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 3.6e9 >= 24.0 AS sufficient
FROM series_rt GROUP BY city""")


def total_sort(spark, sf):
    """SO1: total order by (city, timestamp) (a sink-side sort; range-partitioned by Spark)."""
    return FX.scored(spark, sf).select("city", "timestamp", "obs_id", "us_aqi").orderBy("city", "timestamp", "obs_id")


SQL["total_sort"] = O.with_views(["scored"], 'SELECT city, "timestamp", obs_id, us_aqi FROM scored ORDER BY city, "timestamp", obs_id')


def dedup_last(spark, sf):
    return Q.dedup(FX.dup(spark, sf), ["city", "timestamp"], ["ingest_seq", "obs_id"], keep="last")


SQL["dedup_last"] = O.with_views(["dup"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY ingest_seq DESC, obs_id DESC) AS rn
  FROM dup WHERE city IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1""")


def dedup_first(spark, sf):
    return Q.dedup(FX.dup(spark, sf), ["city", "timestamp"], ["ingest_seq", "obs_id"], keep="first")


SQL["dedup_first"] = O.with_views(["dup"], """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY ingest_seq ASC, obs_id ASC) AS rn
  FROM dup WHERE city IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1""")


def dedup_exact(spark, sf):
    o = FX.obs(spark, sf)
    return Q.dedup_exact(o.unionByName(o.filter(F.col("obs_id") % 10 == 0)))


SQL["dedup_exact"] = O.with_views(["obs"], "SELECT DISTINCT * FROM (SELECT * FROM obs UNION ALL SELECT * FROM obs WHERE obs_id % 10 = 0)")

QUERIES.update({
    "coerce_lenient": coerce_lenient, "coerce_report": coerce_report, "schema_align": schema_align,
    "strict_cast": strict_cast, "strict_rows": strict_rows, "null_profile": null_profile, "quality_overview": quality_overview,
    "feature_availability": feature_availability, "target_check": target_check, "range_check": range_check,
    "history_coverage": history_coverage, "total_sort": total_sort, "dedup_last": dedup_last,
    "dedup_first": dedup_first, "dedup_exact": dedup_exact,
})


def model_input(spark, sf):
    """PR7/PR8/PR9: feature/target split and projection to the columns that a fitted pipeline reads, in its order."""
    from aerolith.operators import ml as ML
    from aerolith.session import cut_lineage
    t = cut_lineage(FE.drop_incomplete(FX.feats(spark, sf)))
    Q.require_columns(t, ML.NUMERIC_FEATURES + ML.CATEGORICAL_FEATURES + [ML.TARGET])
    numeric = [c for c in Q.numeric_columns(t, exclude=["timestamp", ML.TARGET, "n_obs", "year"])
               if c in ML.NUMERIC_FEATURES]
    model = Pipeline(stages=ML.preprocessor_stages(numeric=numeric)).fit(t)
    return t.select("timestamp", *ML.model_columns(model), ML.TARGET)


def _model_input_sql():
    from aerolith.operators import ml as ML
    from aerolith.plans.q_monitoring import TRAIN_SQL
    cols = ", ".join(ML.CATEGORICAL_FEATURES[1:] + ML.NUMERIC_FEATURES + [ML.TARGET])
    return O.with_views(["feats"], f'SELECT city, "timestamp", {cols} FROM train', [("train", TRAIN_SQL)])


SQL["model_input"] = _model_input_sql()


def reject_counts(spark, sf):
    """DQ5: rows rejected for a NULL target or NULL key, from one aggregation."""
    f = FX.feats(spark, sf)
    return f.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("target_aqi").isNull()).alias("null_target"),
                 F.count_if(F.col("city").isNull()).alias("null_key"),
                 F.count_if(F.col("target_aqi").isNotNull() & F.col("city").isNotNull()).alias("accepted"))


SQL["reject_counts"] = O.with_views(["feats"], """
SELECT count(*) AS rows, count(*) FILTER (WHERE target_aqi IS NULL) AS null_target, count(*) FILTER (WHERE city IS NULL) AS null_key,
  count(*) FILTER (WHERE target_aqi IS NOT NULL AND city IS NOT NULL) AS accepted FROM feats""")

QUERIES.update({"model_input": model_input, "reject_counts": reject_counts})
