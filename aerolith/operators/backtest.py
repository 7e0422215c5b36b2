"""Per-entity statistical backtests and scaling (TS8, TS9).

Each entity's gap-free hourly series is split chronologically (first 80 %
train). Baselines are closed-form and computed with windows/aggregates only:

* persistence: last training value;
* seasonal naive (24 h): the training value at the same hour of the last
  training day;
* AR(1) on first differences: phi = regr_slope(d_t, d_{t-1}) on the training
  part, forecast y_T + d_T * (phi + phi^2 + ... + phi^k).

Windows are per entity on hourly grids (bounded by span / 1 h).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

METHODS = ["persistence", "seasonal_naive_24", "ar1_diff"]


def positions(grid: DataFrame, key: str = "city", ts: str = "timestamp", value: str = "us_aqi",
              train_fraction: float = 0.8) -> DataFrame:
    """Per-entity position, size and train/test flag (WN9)."""
    w = Window.partitionBy(key).orderBy(ts)
    return (grid.withColumn("pos", F.row_number().over(w))
            .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(key)))
            .withColumn("n_train", F.floor(F.col("n") * F.lit(train_fraction)).cast("int"))
            .withColumn("is_train", F.col("pos") <= F.col("n_train"))
            .withColumn("y", F.col(value).cast("double")))


def baseline_forecasts(pos: DataFrame, key: str = "city", season: int = 24, digits: int = 6) -> DataFrame:
    """TS8: stacked (method, key, pos, y, y_hat) for every test row and every baseline."""
    w = Window.partitionBy(key).orderBy("pos")
    train = pos.filter("is_train").withColumn("d", F.col("y") - F.lag("y").over(w))
    train = train.withColumn("d_prev", F.lag("d").over(w))
    params = train.groupBy(key).agg(
        F.max_by("y", "pos").alias("y_T"), F.max_by("d", "pos").alias("d_T"),
        F.round(F.regr_slope("d", "d_prev"), digits).alias("phi"))
    test = pos.filter(~F.col("is_train")).withColumn("k", F.col("pos") - F.col("n_train")).join(params, key)
    # seasonal source position inside the last training season
    src = test.withColumn("src_pos", F.col("n_train") - F.lit(season) + F.pmod(F.col("k") - 1, F.lit(season)) + 1)
    lookup = pos.filter("is_train").select(key, F.col("pos").alias("src_pos"), F.col("y").alias("y_season"))
    src = src.join(lookup, [key, "src_pos"], "left")
    phi = F.coalesce(F.col("phi"), F.lit(0.0))
    geo = F.when(phi == 1.0, F.col("k").cast("double")).otherwise(
        phi * (F.lit(1.0) - F.pow(phi, F.col("k"))) / (F.lit(1.0) - phi))
    ar = F.col("y_T") + F.coalesce(F.col("d_T"), F.lit(0.0)) * geo
    base = src.select(key, "pos", "y", F.col("y_T").alias("persistence"), F.col("y_season").alias("seasonal_naive_24"),
                      ar.alias("ar1_diff"))
    return base.unpivot([key, "pos", "y"], METHODS, "method", "y_hat")


def minmax_scale(pos: DataFrame, key: str = "city") -> DataFrame:
    """TS9: per-entity min-max scaling fitted on the training part, applied to all rows."""
    stats = pos.filter("is_train").groupBy(key).agg(F.min("y").alias("y_min"), F.max("y").alias("y_max"))
    out = pos.join(stats, key)
    return out.withColumn("scaled", F.when(F.col("y_max") > F.col("y_min"),
                                           (F.col("y") - F.col("y_min")) / (F.col("y_max") - F.col("y_min"))))


def inverse_scale(c, y_min="y_min", y_max="y_max"):
    return c * (F.col(y_max) - F.col(y_min)) + F.col(y_min)
