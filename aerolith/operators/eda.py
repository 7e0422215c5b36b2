"""Exploratory statistics (AG2-AG11, AG14, AG15).

All are hash aggregations (partial + final) or the distributed exact median
from ``ranking``; global bounds (histogram min/max) enter as scalar
subqueries, so no row is ever joined against a broadcast cartesian product.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.aqi import CATEGORIES, band_index
from aerolith.functions.numeric import clean_double
from aerolith.operators.ranking import median


def group_stats(df: DataFrame, key: str, value: str = "us_aqi", digits: int = 2,
                half_even: bool = True, accuracy: int | None = None) -> DataFrame:
    """AG2/AG6: count, mean, median, min, max, sample std per group (rounded half-even by default).

    The median is exact unless ``accuracy`` selects the approximate sketch.
    """
    rnd = F.bround if half_even else F.round
    v = clean_double(value)
    base = df.filter(F.col(key).isNotNull()).withColumn("_v", v)
    stats = base.groupBy(key).agg(
        F.count("_v").alias("count"),
        rnd(F.avg("_v"), digits).alias("mean"),
        rnd(F.min("_v"), digits).alias("min"),
        rnd(F.max("_v"), digits).alias("max"),
        rnd(F.stddev_samp("_v"), digits).alias("std"),
    )
    med = median(base, [key], "_v", accuracy).withColumn("median", rnd("median", digits))
    return stats.join(med, key, "left").select(key, "count", "mean", "median", "min", "max", "std")


def peak_and_trough(stats: DataFrame, key: str, metric: str = "mean") -> DataFrame:
    """AG6 / SO6: key with the highest and the lowest ``metric`` (first key wins ties)."""
    return stats.agg(
        F.max_by(key, F.struct(F.col(metric), -F.col(key))).alias(f"highest_{key}"),
        F.max(metric).alias(f"highest_{metric}"),
        F.min_by(key, F.struct(F.col(metric), F.col(key))).alias(f"lowest_{key}"),
        F.min(metric).alias(f"lowest_{metric}"),
    )


def category_distribution(df: DataFrame, value: str = "us_aqi") -> DataFrame:
    """AG7: rows per AQI band for all six bands (zero-filled) and share of all rows in percent.

    One global aggregation: every task counts its rows per band (partial
    aggregate), the final aggregate sums one row per task, and the single
    result row is unpivoted into the six bands with ``stack``. No join, no
    second scan for the total, and a band without rows is simply a zero.
    """
    band = band_index(value)
    wide = df.select(band.alias("_b")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col("_b") == F.lit(i)).alias(f"_c{i}") for i in range(1, len(CATEGORIES) + 1)])
    cells = ", ".join(f"{i}, '{c}', _c{i}" for i, c in enumerate(CATEGORIES, start=1))
    out = wide.selectExpr("_n", f"stack({len(CATEGORIES)}, {cells}) AS (band, aqi_category, count)")
    return out.select("band", "aqi_category", "count",
                      F.bround(F.try_divide("count", "_n") * F.lit(100.0), 2).alias("percentage"))


def histogram(df: DataFrame, value: str = "us_aqi", bins: int = 40) -> DataFrame:
    """AG11: equal-width histogram between min and max (last bin closed), empty bins omitted.

    A constant column has one bin, 0.
    """
    v = clean_double(value)
    vals = df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
    bounds = vals.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.coalesce(F.floor((F.col("_v") - lo) * F.try_divide(F.lit(float(bins)), hi - lo)), F.lit(0)), F.lit(bins - 1)).cast("bigint")
    return vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")).select(
        "bin", F.round(lo + F.col("bin") * width, 6).alias("bin_start"), "count")


def correlation_pairs(df: DataFrame, features: list[str], digits: int = 6) -> DataFrame:
    """AG9: Pearson correlation of every feature pair (pairwise-complete), long format, one pass."""
    pairs = list(combinations(features, 2))
    # one SQL expression per pair: a single call each to build (F.corr + casts cost ~6 per pair)
    wide = df.agg(*[F.expr(f"corr(CAST(`{a}` AS DOUBLE), CAST(`{b}` AS DOUBLE)) AS `{i}`")
                    for i, (a, b) in enumerate(pairs)])
    stack = ", ".join(f"'{a}', '{b}', `{i}`" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (feature_a, feature_b, correlation)") \
        .withColumn("correlation", F.round("correlation", digits))


def target_correlation(df: DataFrame, features: list[str], target: str = "target_aqi", digits: int = 6) -> DataFrame:
    """AG10: correlation of each feature with the target, ranked by absolute value (desc)."""
    wide = df.agg(*[F.expr(f"corr(CAST(`{f}` AS DOUBLE), CAST(`{target}` AS DOUBLE)) AS `{f}`") for f in features])
    stack = ", ".join(f"'{f}', `{f}`" for f in features)
    long = wide.selectExpr(f"stack({len(features)}, {stack}) AS (feature, correlation)")
    long = long.withColumn("correlation", F.round("correlation", digits))
    # a final ranking over <= number-of-features rows
    w = Window.orderBy(F.abs("correlation").desc_nulls_last(), F.col("feature"))
    return long.withColumn("rank", F.row_number().over(w).cast("bigint"))


def range_summary(df: DataFrame, key: str = "city", ts: str = "timestamp") -> DataFrame:
    """AG14: rows, distinct entities, first and last time."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("entities"),
                  F.min(ts).alias("first_timestamp"), F.max(ts).alias("last_timestamp"))
