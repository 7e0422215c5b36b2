"""Hand-computed cases for the scalar functions (boundaries, gaps, NaN, bands)."""

import math

from pyspark.sql import functions as F

from aerolith.functions import aqi as A
from aerolith.functions.calendar import calendar_columns


def _one(spark, expr, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_pm25_boundaries_gap_and_invalid(spark):
    vals = [(12.0,), (12.05,), (12.1,), (600.0,), (-1.0,), (None,), (float("nan"),), (0.0,), (35.4,), (35.45,)]
    got = _one(spark, A.sub_index("x", A.PM25_BREAKPOINTS), vals, "x double")
    assert got == [50, None, 51, 500, None, None, None, 0, 100, None]


def test_pm10_gap(spark):
    got = _one(spark, A.sub_index("x", A.PM10_BREAKPOINTS), [(54.0,), (54.5,), (55.0,), (604.0,), (605.0,)], "x double")
    assert got == [50, None, 51, 500, 500]


def test_us_aqi_reference_example_and_both_gaps(spark):
    df = spark.createDataFrame([(36.76, 111.54), (12.05, 54.5), (None, 60.0)], "a double, b double")
    got = [r[0] for r in df.select(A.us_aqi("a", "b")).collect()]
    assert got == [104, None, 53]


def test_category_alert_bands(spark):
    vals = [(50.0,), (51.0,), (100.0,), (150.0,), (200.0,), (300.0,), (301.0,), (None,)]
    cats = _one(spark, A.aqi_category("x"), vals, "x double")
    assert cats == ["Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
                    "Very Unhealthy", "Hazardous", "Unknown"]
    alerts = _one(spark, A.alert_level("x"), vals, "x double")
    assert alerts == ["Normal", "Normal", "Normal", "Caution", "Warning", "High Alert", "Emergency", "Unknown"]


def test_guidance_variants_and_activity(spark):
    df = spark.createDataFrame([(40.0,), (None,)], "x double")
    r = df.select(A.health_guidance("x", "forecast"), A.activity_recommendation("x")["level"]).collect()
    assert r[0][0].startswith("Air quality is satisfactory") and r[0][1] == "Excellent"
    assert r[1][0] == "AQI information is unavailable." and r[1][1] == "Unknown"


def test_clip_round_half_even(spark):
    got = _one(spark, A.clip_prediction("x"), [(-3.0,), (612.0,), (2.345,), (2.355,)], "x double")
    assert got[0] == 0.0 and got[1] == 500.0 and got[2] == 2.34 and got[3] == 2.36


def test_calendar_and_season(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-06 13:00:00' AS t, TIMESTAMP_NTZ '2024-07-01 00:00:00' AS u")
    c1 = calendar_columns("t")
    c2 = calendar_columns("u")
    r = df.select(c1["day_of_week"], c1["is_weekend"], c1["season"], c2["season"], c2["is_weekend"]).first()
    assert tuple(r) == ("Saturday", 1, "Winter", "Summer", 0)


def test_rolling_gate_and_lags(spark):
    from aerolith.operators.features import add_history_features
    rows = [("a", i, v) for i, v in enumerate([1.0, None, 3.0, 4.0, 5.0])]
    df = spark.createDataFrame(rows, "city string, timestamp int, us_aqi double")
    out = add_history_features(df, lags=[1], windows=[3]).orderBy("timestamp").collect()
    assert [r["aqi_roll_3"] for r in out] == [None, None, None, None, 4.0]
    assert [r["aqi_lag_1"] for r in out] == [None, 1.0, None, 3.0, 4.0]


def test_canonical_lookup_accent_and_case(spark):
    from aerolith.operators.joins import canonical_lookup
    probes = spark.createDataFrame([("Siālkot",), (" lahore ",), ("Nowhere",)], "raw_name string")
    dim = spark.createDataFrame([("Sialkot",), ("Lahore",)], "entity string")
    got = {r["raw_name"]: r["canonical_name"] for r in canonical_lookup(probes, dim).collect()}
    assert got == {"Siālkot": "Sialkot", " lahore ": "Lahore", "Nowhere": None}


def test_version_parsing(spark):
    from aerolith.operators.registry import next_version
    df = spark.createDataFrame([("m", "v1"), ("m", "V7"), ("m", "3"), ("m", "bad"), ("n", "x")], "model string, version string")
    got = {r["model"]: r["next_version"] for r in next_version(df).collect()}
    assert got == {"m": "v8", "n": "v1"}


def test_nan_is_normalised(spark):
    got = _one(spark, A.aqi_category("x"), [(float("nan"),)], "x double")
    assert got == ["Unknown"] and math.isnan(float("nan"))
