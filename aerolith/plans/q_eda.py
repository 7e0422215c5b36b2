"""Registered queries: exploratory statistics (AG2-AG11, AG14, SO6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import eda as E
from aerolith.operators.ranking import median
from aerolith.plans import oracle as O
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}

CORR_FEATURES = ["us_aqi", "pm2_5", "pm10", "temperature", "hour", "is_weekend",
                 "aqi_lag_1", "aqi_lag_3", "aqi_lag_6", "aqi_lag_24", "aqi_roll_3", "aqi_roll_6", "aqi_roll_24"]


def entity_stats(spark, sf):
    return E.group_stats(FX.scored(spark, sf), "city", "us_aqi", 2)


SQL["entity_stats"] = O.with_views(["scored"], """
SELECT city, count(us_aqi) AS count, round_even(avg(us_aqi), 2) AS mean,
  round_even(quantile_cont(us_aqi, 0.5), 2) AS median, round_even(min(us_aqi)::DOUBLE, 2) AS min,
  round_even(max(us_aqi)::DOUBLE, 2) AS max, round_even(stddev_samp(us_aqi), 2) AS std
FROM scored WHERE city IS NOT NULL GROUP BY city""")


def station_stats(spark, sf):
    """AG2 keyed by the sparse station entity (exact medians for many groups)."""
    return E.group_stats(FX.scored(spark, sf), "station_id", "pm2_5", 6, half_even=False)


SQL["station_stats"] = O.with_views(["scored"], """
SELECT station_id, count(pm2_5) AS count, round(avg(pm2_5), 6) AS mean,
  round(quantile_cont(pm2_5, 0.5), 6) AS median, round(min(pm2_5), 6) AS min,
  round(max(pm2_5), 6) AS max, round(stddev_samp(pm2_5), 6) AS std
FROM scored WHERE station_id IS NOT NULL GROUP BY station_id""")


def entity_mean(spark, sf):
    """AG3: mean AQI per entity, ascending."""
    s = FX.scored(spark, sf).filter(F.col("city").isNotNull())
    return s.groupBy("city").agg(F.round(F.avg("us_aqi"), 6).alias("mean_aqi")).orderBy("mean_aqi")


SQL["entity_mean"] = O.with_views(["scored"], """
SELECT city, round(avg(us_aqi), 6) AS mean_aqi FROM scored WHERE city IS NOT NULL GROUP BY city ORDER BY mean_aqi""")


def daily_mean(spark, sf):
    """AG4: daily mean AQI per entity."""
    s = FX.scored(spark, sf).filter(F.col("city").isNotNull())
    return s.groupBy(F.date_trunc("day", "timestamp").alias("day"), "city").agg(
        F.round(F.avg("us_aqi"), 6).alias("mean_aqi"))


SQL["daily_mean"] = O.with_views(["scored"], """
SELECT CAST(date_trunc('day', "timestamp") AS TIMESTAMP) AS day, city, round(avg(us_aqi), 6) AS mean_aqi
FROM scored WHERE city IS NOT NULL GROUP BY ALL""")


def monthly_pivot(spark, sf):
    """AG5: month x entity mean (pivot on the entity; its distinct values become columns)."""
    s = FX.scored(spark, sf).filter(F.col("city").isNotNull())
    p = s.groupBy(F.month("timestamp").cast("bigint").alias("month")).pivot("city").agg(F.avg("us_aqi"))
    return p.select("month", *[F.round(F.col(c), 6).alias(c) for c in p.columns if c != "month"])


SQL["monthly_pivot"] = O.with_views(["scored"], """
SELECT CAST(month("timestamp") AS BIGINT) AS month,
  """ + ", ".join(f"round(avg(us_aqi) FILTER (WHERE city = '{c}'), 6) AS \"{c}\"" for c in ("click", "error", "purchase", "signup", "view")) + """
FROM scored WHERE city IS NOT NULL GROUP BY 1""")


def hourly_pattern(spark, sf):
    f = FX.feats(spark, sf)
    return E.group_stats(f, "hour", "us_aqi", 2).drop("min", "max")


SQL["hourly_pattern"] = O.with_views(["feats"], """
SELECT hour, count(us_aqi) AS count, round_even(avg(us_aqi), 2) AS mean, round_even(quantile_cont(us_aqi, 0.5), 2) AS median,
  round_even(stddev_samp(us_aqi), 2) AS std FROM feats GROUP BY hour""")


def peak_hours(spark, sf):
    return E.peak_and_trough(hourly_pattern(spark, sf), "hour", "mean")


SQL["peak_hours"] = O.with_views(["feats"], """
WITH h AS (SELECT hour, round_even(avg(us_aqi), 2) AS mean FROM feats GROUP BY hour)
SELECT arg_max(hour, (mean, -hour)) AS highest_hour, max(mean) AS highest_mean,
       arg_min(hour, (mean, hour)) AS lowest_hour, min(mean) AS lowest_mean FROM h""")


def category_distribution(spark, sf):
    return E.category_distribution(FX.scored(spark, sf))


SQL["category_distribution"] = O.with_views(["scored"], f"""
WITH b AS (SELECT * FROM (VALUES {', '.join(f"({i}, {O.q(c)})" for i, c in enumerate(E.CATEGORIES, start=1))}) t(band, aqi_category)),
c AS (SELECT {O.category_sql('us_aqi')} AS aqi_category, count(*) AS n FROM scored WHERE us_aqi IS NOT NULL GROUP BY 1)
SELECT b.band, b.aqi_category, coalesce(c.n, 0) AS count,
  round_even(coalesce(c.n, 0) / (SELECT count(*) FROM scored) * 100.0, 2) AS percentage
FROM b LEFT JOIN c USING (aqi_category)""")


def histogram_40(spark, sf):
    return E.histogram(FX.scored(spark, sf), "pm2_5", 40)


SQL["histogram_40"] = O.with_views(["scored"], """
WITH s AS (SELECT min(pm2_5) AS lo, max(pm2_5) AS hi FROM scored),
b AS (SELECT CAST(least(floor((pm2_5 - s.lo) * (40.0 / (s.hi - s.lo))), 39) AS BIGINT) AS bin FROM scored, s WHERE pm2_5 IS NOT NULL)
SELECT bin, round((SELECT lo FROM s) + bin * (((SELECT hi FROM s) - (SELECT lo FROM s)) / 40.0), 6) AS bin_start, count(*) AS count
FROM b GROUP BY bin""")


def distribution_summary(spark, sf):
    """AG11: overall mean and median of the AQI."""
    s = FX.scored(spark, sf)
    m = median(s, [], "us_aqi")
    mean = s.agg(F.avg("us_aqi")).scalar()
    return m.select(F.round(mean, 6).alias("mean_aqi"), F.round("median", 6).alias("median_aqi"))


SQL["distribution_summary"] = O.with_views(["scored"], """
SELECT round(avg(us_aqi), 6) AS mean_aqi, round(quantile_cont(us_aqi, 0.5), 6) AS median_aqi FROM scored""")


def correlation_matrix(spark, sf):
    return E.correlation_pairs(FX.feats(spark, sf), CORR_FEATURES)


def _corr_sql():
    from itertools import combinations
    parts = [f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM feats"
             for a, b in combinations(CORR_FEATURES, 2)]
    return O.with_views(["feats"], " UNION ALL ".join(parts))


SQL["correlation_matrix"] = _corr_sql()


def target_correlation(spark, sf):
    feats = [f for f in CORR_FEATURES]
    return E.target_correlation(FX.feats(spark, sf), feats)


def _tc_sql():
    parts = [f"SELECT '{a}' AS feature, round(corr({a}, target_aqi), 6) AS correlation FROM feats" for a in CORR_FEATURES]
    return O.with_views(["feats"], "SELECT feature, correlation, CAST(row_number() OVER (ORDER BY abs(correlation) DESC NULLS LAST, feature) AS BIGINT) AS rank FROM ("
                        + " UNION ALL ".join(parts) + ")")


SQL["target_correlation"] = _tc_sql()


def range_summary(spark, sf):
    return E.range_summary(FX.scored(spark, sf))


SQL["range_summary"] = O.with_views(["scored"], """
SELECT count(*) AS rows, count(DISTINCT city) AS entities, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp FROM scored""")

QUERIES.update({
    "entity_stats": entity_stats, "station_stats": station_stats, "entity_mean": entity_mean,
    "daily_mean": daily_mean, "monthly_pivot": monthly_pivot, "hourly_pattern": hourly_pattern,
    "peak_hours": peak_hours, "category_distribution": category_distribution, "histogram_40": histogram_40,
    "distribution_summary": distribution_summary, "correlation_matrix": correlation_matrix,
    "target_correlation": target_correlation, "range_summary": range_summary,
})
