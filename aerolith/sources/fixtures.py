"""Observation views derived from the shared test tables.

The test tables carry no sensor data, so observations are derived from
``events`` (and ``part`` / ``nation`` for registry and entity lookups). Each
view is a lazy DataFrame; the same definitions exist as SQL CTEs in
``aerolith.plans.oracle`` so both engines see identical inputs.

* ``obs``      one row per event: city = event_type (5 dense entities),
               station_id = user_id (many sparse entities), pm2_5 = value,
               pm10 = 2*value + k/10, temperature = 10 + 0.3*k with k = props.k.
* ``scored``   obs + sub-indices + us_aqi.
* ``series``   hourly mean per city (us_aqi rounded half-even, others 6 dp).
* ``feats``    series + calendar + lags + rolling means + 3-step-ahead target.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.functions.aqi import with_aqi
from aerolith.functions.calendar import with_calendar

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("event_id").alias("obs_id"),
        F.col("event_type").alias("city"),
        F.col("user_id").alias("station_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("pm2_5"),
        (F.lit(2) * F.col("value") + k / F.lit(10)).alias("pm10"),
        (F.lit(10) + F.lit(0.3) * k).alias("temperature"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_aqi(obs(spark, sf_dir))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly per-city series (one row per city and hour that has observations)."""
    from aerolith.operators.features import bucket_mean

    return bucket_mean(scored(spark, sf_dir), key="city", ts="timestamp", hours=1,
                       columns=["pm2_5", "pm10", "temperature", "us_aqi"], digits=6)


def feats(spark: SparkSession, sf_dir: str, hourly: DataFrame | None = None) -> DataFrame:
    """Training-style feature rows: series + calendar + lag/rolling + target (nulls kept).

    ``hourly`` is an already built (e.g. materialised) ``series`` to start from.
    """
    from aerolith.operators.features import add_history_features, add_target

    s = with_calendar(hourly if hourly is not None else series(spark, sf_dir), "timestamp")
    return add_target(add_history_features(s, key="city", ts="timestamp", value="us_aqi"),
                      key="city", ts="timestamp", value="us_aqi", horizon=3)


def obs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs as strings with injected defects: bad timestamp (id % 97), bad number (id % 89), NULL city (id % 83)."""
    o = obs(spark, sf_dir)
    i = F.col("obs_id")
    return o.select(
        "obs_id",
        F.when(i % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("city")).alias("city"),
        F.col("station_id").cast("string").alias("station_id"),
        F.when(i % 97 == 0, F.lit("not-a-time"))
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.when(i % 89 == 0, F.lit("n/a")).otherwise(F.col("pm2_5").cast("string")).alias("pm2_5"),
        F.col("pm10").cast("string").alias("pm10"),
        F.col("temperature").cast("string").alias("temperature"),
    )


def dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs (ingest_seq 0) plus every 10th row again with pm2_5 + 1 (ingest_seq 1)."""
    o = obs(spark, sf_dir)
    again = o.filter(F.col("obs_id") % 10 == 0).withColumn("pm2_5", F.col("pm2_5") + F.lit(1.0))
    return o.withColumn("ingest_seq", F.lit(0)).unionByName(again.withColumn("ingest_seq", F.lit(1)))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return obs(spark, sf_dir).select("obs_id", "city", "timestamp", "station_id", "temperature")


def pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pollution side of obs with one row in 50 missing (failed lookups)."""
    return (obs(spark, sf_dir).filter(F.col("obs_id") % 50 != 0)
            .select("obs_id", "city", "timestamp", "pm2_5", "pm10"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-run history derived from ``part``: one registered version per part."""
    p = table(spark, sf_dir, "part")
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    return p.select(
        F.col("p_brand").alias("model"),
        F.row_number().over(w).cast("bigint").alias("version_no"),
        F.col("p_partkey").alias("run_id"),
        (F.lit(5.0) + ((F.col("p_partkey") * 7919) % 997).cast("double") / F.lit(100.0)).alias("rmse"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical entity dimension (``nation``)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("entity_id"), F.col("n_name").alias("entity"))


# Fixed probe spellings for the canonical-name lookup test (accents, case, padding).
ENTITY_PROBES = ["nation_1", " NATION_2 ", "Nätión_3", "nàtion_4", "NATION_99", "Natiön_10"]


def entity_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe names: every nation name lower-cased and padded, plus fixed accented spellings."""
    n = table(spark, sf_dir, "nation")
    base = n.select(F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("raw_name"))
    lit_rows = spark.createDataFrame([(s,) for s in ENTITY_PROBES], "raw_name string")
    return base.unionByName(lit_rows)


def series_halves(spark: SparkSession, sf_dir: str, hourly: DataFrame | None = None,
                  columns: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(real-time, historical) series with further ``columns``: two cities of the real-time side keep only their last 12 h."""
    s = (hourly if hourly is not None else series(spark, sf_dir)).select("city", "timestamp", "us_aqi", *columns)
    last = s.groupBy("city").agg(F.max("timestamp").alias("last_ts"))
    rt = (s.join(last, "city")
          .filter(~F.col("city").isin("click", "error")
                  | (F.col("timestamp") > F.col("last_ts") - F.expr("INTERVAL 12 HOURS")))
          .drop("last_ts"))
    return rt, s
