"""Provider payload decoding (IO5-IO8): JSON text -> typed rows, all JVM-side.

* columnar payloads (parallel arrays under ``hourly``) become one row per
  hour with ``inline(arrays_zip(...))``;
* nested payloads are parsed with ``from_json`` and flattened by field
  access; a missing or empty list yields no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOURLY_AIR_FIELDS = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide", "sulphur_dioxide", "ozone", "us_aqi"]
# Provider weather field -> training-schema name.
HOURLY_WEATHER_RENAMES = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "surface_pressure": "pressure",
    "cloud_cover": "cloud_cover",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "precipitation": "precipitation",
}
HOURLY_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"

POLLUTION_SCHEMA = T.StructType([T.StructField("list", T.ArrayType(T.StructType([
    T.StructField("main", T.StructType([T.StructField("aqi", T.IntegerType())])),
    T.StructField("components", T.StructType([T.StructField(c, T.DoubleType()) for c in
                                              ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]])),
    T.StructField("dt", T.LongType()),
])))])

WEATHER_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("coord", T.StructType([T.StructField(c, T.DoubleType()) for c in ["lat", "lon"]])),
    T.StructField("clouds", T.StructType([T.StructField("all", T.DoubleType())])),
    T.StructField("visibility", T.DoubleType()),
    T.StructField("weather", T.ArrayType(T.StructType([T.StructField("description", T.StringType())]))),
    T.StructField("main", T.StructType([T.StructField(c, T.DoubleType()) for c in ["temp", "pressure", "humidity"]])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
])


def hourly_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(f, T.ArrayType(T.DoubleType())) for f in fields]))])


def decode_hourly(df: DataFrame, payload: str, fields: list[str], renames: dict[str, str] | None = None,
                  keep: list[str] = ()) -> DataFrame:
    """IO5/IO6: parallel arrays -> one row per hour (``timestamp`` + one column per field)."""
    parsed = df.select(*keep, F.from_json(payload, hourly_schema(fields)).alias("_p"))
    zipped = parsed.select(*keep, F.inline(F.arrays_zip(
        F.col("_p.hourly.time").alias("time"), *[F.col(f"_p.hourly.{f}").alias(f) for f in fields])))
    out = zipped.select(*keep, F.to_timestamp_ntz("time", F.lit(HOURLY_TIME_FORMAT)).alias("timestamp"),
                        *[F.col(f).alias((renames or {}).get(f, f)) for f in fields])
    return out


def decode_pollution(df: DataFrame, payload: str, keep: list[str] = ()) -> DataFrame:
    """IO8: first list item of a nested pollution payload; missing/empty list -> no row."""
    first = F.try_element_at(F.from_json(payload, POLLUTION_SCHEMA)["list"], F.lit(1))
    out = df.select(*keep, first.alias("_i")).filter(F.col("_i").isNotNull())
    comps = ["co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3"]
    return out.select(*keep, F.col("_i.main.aqi").alias("aqi"), *[F.col(f"_i.components.{c}").alias(c) for c in comps],
                      F.col("_i.dt").alias("api_timestamp"))


def decode_weather(df: DataFrame, payload: str, keep: list[str] = ()) -> DataFrame:
    """IO7: nested weather payload flattened; description from ``weather[0]``."""
    p = F.from_json(payload, WEATHER_SCHEMA)
    return df.select(*keep, p.alias("_w")).select(
        *keep, F.col("_w.name").alias("city"), F.col("_w.coord.lat").alias("latitude"), F.col("_w.coord.lon").alias("longitude"),
        F.col("_w.clouds.all").alias("cloud_cover"), F.col("_w.visibility").alias("visibility"), F.col("_w.main.temp").alias("temperature"), F.col("_w.main.pressure").alias("pressure"),
        F.col("_w.main.humidity").alias("humidity"), F.col("_w.wind.speed").alias("wind_speed"),
        F.try_element_at(F.col("_w.weather"), F.lit(1))["description"].alias("weather"))


def encode_hourly(df: DataFrame, keys: list[str], ts: str, fields: list[str]) -> Column:
    """Inverse of ``decode_hourly`` for one group (used to build payload fixtures per entity-day)."""
    srt = F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), *[F.col(f) for f in fields])))
    return F.to_json(F.struct(F.struct(
        F.transform(srt, lambda s: F.date_format(s["t"], HOURLY_TIME_FORMAT)).alias("time"),
        *[F.transform(srt, _field(f)).alias(f) for f in fields]).alias("hourly")))


def _field(name: str):
    return lambda s: s[name]
