"""Registered queries: joins, lookups and set operations (JN1-JN3, JN8, JN9, DQ11, ST1-ST3, PR6, AG8, AG15)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions.aqi import aqi_category
from aerolith.operators import joins as J
from aerolith.operators import quality as Q
from aerolith.plans import oracle as O
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}
KEYS = ["obs_id", "city", "timestamp"]


def merge_weather_pollution(spark, sf):
    return J.merge_on_keys(FX.weather(spark, sf), FX.pollution(spark, sf), KEYS)


SQL["merge_weather_pollution"] = O.with_views(["weather", "pollution"], """
SELECT w.obs_id, w.city, w."timestamp", w.station_id, w.temperature, p.pm2_5, p.pm10
FROM weather w JOIN pollution p ON w.obs_id = p.obs_id AND w.city = p.city AND w."timestamp" = p."timestamp" """)


def enrich_inner(spark, sf):
    """JN2: the pollution side carries its own temperature reading, which overwrites the weather one."""
    pol = FX.pollution(spark, sf).withColumn("temperature", F.col("pm10") / F.lit(20.0))
    return J.enrich(FX.weather(spark, sf), pol, KEYS)


SQL["enrich_inner"] = O.with_views(["weather", "pollution"], """
SELECT w.obs_id, w.city, w."timestamp", w.station_id, p.pm2_5, p.pm10, p.pm10 / 20.0::DOUBLE AS temperature
FROM weather w JOIN pollution p ON w.obs_id = p.obs_id AND w.city = p.city AND w."timestamp" = p."timestamp" """)


def unmatched_weather(spark, sf):
    return J.unmatched(FX.weather(spark, sf), FX.pollution(spark, sf), KEYS)


SQL["unmatched_weather"] = O.with_views(["weather", "pollution"], """
SELECT * FROM weather w WHERE NOT EXISTS (SELECT 1 FROM pollution p
  WHERE w.obs_id = p.obs_id AND w.city = p.city AND w."timestamp" = p."timestamp")""")


def canonical_entity(spark, sf):
    return J.canonical_lookup(FX.entity_probes(spark, sf), FX.entities(spark, sf))


SQL["canonical_entity"] = f"""
WITH probes AS (SELECT ' ' || lower(n_name) || ' ' AS raw_name FROM nation
  UNION ALL SELECT unnest([{', '.join(O.q(s) for s in FX.ENTITY_PROBES)}]))
SELECT p.raw_name, n.n_name AS canonical_name, n.n_name IS NOT NULL AS is_known
FROM probes p LEFT JOIN nation n ON strip_accents(lower(trim(p.raw_name))) = strip_accents(lower(n.n_name))"""


def union_align(spark, sf):
    w = FX.weather(spark, sf).withColumn("source", F.lit("weather"))
    p = FX.pollution(spark, sf).withColumn("source", F.lit("pollution"))
    return Q.union_align(w, p)


SQL["union_align"] = O.with_views(["weather", "pollution"], """
SELECT obs_id, city, "timestamp", station_id, temperature, NULL::DOUBLE AS pm2_5, NULL::DOUBLE AS pm10, 'weather' AS source FROM weather
UNION ALL
SELECT obs_id, city, "timestamp", NULL::BIGINT, NULL::DOUBLE, pm2_5, pm10, 'pollution' FROM pollution""")


def entity_union(spark, sf):
    rt, hist = FX.series_halves(spark, sf)
    return J.distinct_union(rt.select("city"), hist.select("city"),
                            FX.scored(spark, sf).select(F.col("city")))


SQL["entity_union"] = O.with_views(["series_rt", "series_hist", "scored"], """
SELECT city FROM series_rt UNION SELECT city FROM series_hist UNION SELECT city FROM scored""")


def series_similarity(spark, sf):
    """JN8/AG15: two entities paired on common hours: overlap, identical share, max |diff|, correlation."""
    pairs = J.pair_on_time(FX.series(spark, sf), "city", "timestamp", "us_aqi", "click", "view")
    return pairs.agg(
        F.count(F.lit(1)).alias("common_hours"),
        F.round(F.avg((F.col("value_a") == F.col("value_b")).cast("double")), 6).alias("identical_share"),
        F.max(F.abs(F.col("value_a") - F.col("value_b"))).alias("max_abs_diff"),
        F.round(F.corr("value_a", "value_b"), 6).alias("correlation"),
    )


SQL["series_similarity"] = O.with_views(["series"], """
SELECT count(*) AS common_hours, round(avg(CAST(a.us_aqi = b.us_aqi AS DOUBLE)), 6) AS identical_share,
  max(abs(a.us_aqi - b.us_aqi)) AS max_abs_diff, round(corr(a.us_aqi, b.us_aqi), 6) AS correlation
FROM (SELECT * FROM series WHERE city = 'click') a JOIN (SELECT * FROM series WHERE city = 'view') b USING ("timestamp")
WHERE a.us_aqi IS NOT NULL AND b.us_aqi IS NOT NULL""")


def hazardous_by_entity(spark, sf):
    """AG8/JN9: rows in the Hazardous band per entity, zero-filled for every entity."""
    s = FX.scored(spark, sf).filter(F.col("city").isNotNull())
    return s.groupBy("city").agg(F.count_if(aqi_category("us_aqi") == "Hazardous").alias("hazardous_rows"))


SQL["hazardous_by_entity"] = O.with_views(["scored"], """
SELECT city, count(*) FILTER (WHERE us_aqi > 300) AS hazardous_rows FROM scored WHERE city IS NOT NULL GROUP BY city""")


def hazardous_by_station(spark, sf):
    """JN9 with the sparse entity: zero-filled via a left join from the distinct key list."""
    s = FX.scored(spark, sf)
    return J.zero_filled_counts(s, s.filter(F.col("us_aqi") > 300), "station_id", "hazardous_rows")


SQL["hazardous_by_station"] = O.with_views(["scored"], """
SELECT k.station_id, coalesce(c.n, 0) AS hazardous_rows FROM (SELECT DISTINCT station_id FROM scored) k
LEFT JOIN (SELECT station_id, count(*) AS n FROM scored WHERE us_aqi > 300 GROUP BY station_id) c USING (station_id)""")

QUERIES.update({
    "merge_weather_pollution": merge_weather_pollution, "enrich_inner": enrich_inner,
    "unmatched_weather": unmatched_weather, "canonical_entity": canonical_entity, "union_align": union_align,
    "entity_union": entity_union, "series_similarity": series_similarity,
    "hazardous_by_entity": hazardous_by_entity, "hazardous_by_station": hazardous_by_station,
})
