"""Registered queries: streaming ingest (SM1-SM5). Each query drains the ``events`` file stream with
``availableNow`` into a sink on shared storage and returns the sink table."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.plans import oracle as O
from aerolith.sources import manifest as M
from aerolith.streaming import ingest as S

QUERIES, SQL = {}, {}


def _dup_stream(spark, sf):
    """The streamed counterpart of the ``dup`` view: the event stream plus a re-delivered tenth of it."""
    base = S.event_stream(spark, sf).withColumn("ingest_seq", F.lit(0))
    again = (S.event_stream(spark, sf).filter(F.col("obs_id") % 10 == 0)
             .withColumn("pm2_5", F.col("pm2_5") + F.lit(1.0)).withColumn("ingest_seq", F.lit(1)))
    return base.unionByName(again)


DEDUP_KEYS, DEDUP_ORDER = ("city", "timestamp"), ("ingest_seq", "obs_id")


def _dedup(spark, sf, name, newest):
    path, ckpt = S.sink_dirs(spark, name)
    stream = _dup_stream(spark, sf).drop("event_time")
    S.run_available(S.append_batches(stream, path, ckpt, DEDUP_KEYS, DEDUP_ORDER, arrival=True, newest=newest))
    return S.merge_batches(spark, path, stream.schema, DEDUP_KEYS, DEDUP_ORDER, arrival=True, newest=newest)


def stream_dedup_first(spark, sf):
    """SM1 keep-first: the first delivery of every key, with all its columns."""
    return _dedup(spark, sf, "dedup-first", newest=False)


def stream_dedup_last(spark, sf):
    """SM1 keep-last: the last delivery of every key, with all its columns."""
    return _dedup(spark, sf, "dedup-last", newest=True)


for _name, _sort in (("stream_dedup_first", ""), ("stream_dedup_last", " DESC")):
    SQL[_name] = O.with_views(["dup"], f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, "timestamp" ORDER BY ingest_seq{_sort}, obs_id{_sort}) AS rn
  FROM dup WHERE city IS NOT NULL AND "timestamp" IS NOT NULL) WHERE rn = 1""")


def stream_bucket_3h(spark, sf):
    """SM2: tumbling 3-hour means per entity, of all windows and rows."""
    path, ckpt = S.sink_dirs(spark, "bucket-3h")
    S.run_available(S.append_partials(S.scored_stream(spark, sf), path, ckpt))
    return S.means_on_read(spark, path)


SQL["stream_bucket_3h"] = O.with_views(["scored"], """
SELECT city, time_bucket(INTERVAL 3 HOUR, "timestamp") AS "timestamp", round(avg(pm2_5), 6) AS pm2_5,
  round_even(avg(us_aqi), 0) AS us_aqi, count(*) AS n_obs FROM scored GROUP BY 1, 2""")


def stream_latest(spark, sf):
    """SM3: latest row per entity maintained by foreachBatch upserts."""
    path, ckpt = S.sink_dirs(spark, "latest")
    stream = S.scored_stream(spark, sf).select("city", "timestamp", "obs_id", "us_aqi")
    S.run_available(S.append_batches(stream, path, ckpt, ["city"], ["timestamp", "obs_id"]))
    return S.merge_batches(spark, path, stream.schema, ["city"], ["timestamp", "obs_id"])


SQL["stream_latest"] = O.with_views(["scored"], """
SELECT city, "timestamp", obs_id, us_aqi FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY "timestamp" DESC, obs_id DESC) AS rn
  FROM scored) WHERE rn = 1""")


def _checked(spark, sf):
    """SM4: the stream arrives with text times (every 97th unparsable, every 101st missing, every 83rd without key)."""
    src = S.event_stream(spark, sf)
    raw = src.select(
        "obs_id", F.when(F.col("obs_id") % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("city")).alias("city"),
        F.when(F.col("obs_id") % 97 == 0, F.lit("not-a-time")).when(F.col("obs_id") % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("raw_timestamp"), "pm2_5")
    path, ckpt = S.sink_dirs(spark, "rejects")
    query = S.run_available(S.append_checked(raw, path, ckpt))
    rows = M.read(spark, path, "obs_id long, city string, raw_timestamp string, pm2_5 double, timestamp timestamp_ntz, reason string")
    return rows, query


def stream_rejects(spark, sf):
    """SM4: the valid rows."""
    return _checked(spark, sf)[0].where(F.col("reason") == S.VALID).drop("reason", "raw_timestamp")


def stream_dead_letters(spark, sf):
    """SM4: the rejected rows as they came, with the reason."""
    return _checked(spark, sf)[0].where(F.col("reason") != S.VALID).drop("timestamp")


def stream_quality_counts(spark, sf):
    """SM4: counts of the query's progress, added over its batches."""
    query = _checked(spark, sf)[1]
    counts = spark.createDataFrame(S.observed_counts(query), "batch long, count string, value long")
    return counts.groupBy("count").agg(F.sum("value").alias("value"))


CHECKED_VIEWS = [("raw", """SELECT obs_id, CASE WHEN obs_id % 83 <> 0 THEN city END AS city, pm2_5,
    CASE WHEN obs_id % 97 = 0 THEN 'not-a-time' WHEN obs_id % 101 = 0 THEN NULL ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS raw_timestamp FROM obs"""),
    ("checked", """SELECT *, try_strptime(raw_timestamp, '%Y-%m-%d %H:%M:%S') AS "timestamp", CASE WHEN raw_timestamp IS NULL THEN 'missing_timestamp'
    WHEN try_strptime(raw_timestamp, '%Y-%m-%d %H:%M:%S') IS NULL THEN 'invalid_timestamp' WHEN city IS NULL THEN 'missing_key' ELSE 'valid' END AS reason FROM raw""")]
SQL["stream_rejects"] = O.with_views(["obs"], """SELECT obs_id, city, "timestamp", pm2_5 FROM checked WHERE reason = 'valid'""", CHECKED_VIEWS)
SQL["stream_dead_letters"] = O.with_views(["obs"], "SELECT obs_id, city, raw_timestamp, pm2_5, reason FROM checked WHERE reason <> 'valid'", CHECKED_VIEWS)
SQL["stream_quality_counts"] = O.with_views(["obs"], """
SELECT c AS "count", v::BIGINT AS value FROM (SELECT unnest(['rows', 'missing_timestamp', 'invalid_timestamp', 'missing_key', 'valid', 'dropped_by_watermark']) AS c,
  unnest([count(*), count(*) FILTER (WHERE reason = 'missing_timestamp'), count(*) FILTER (WHERE reason = 'invalid_timestamp'),
    count(*) FILTER (WHERE reason = 'missing_key'), count(*) FILTER (WHERE reason = 'valid'), 0]) AS v FROM checked)""", CHECKED_VIEWS)


def stream_state_lag(spark, sf):
    """SM5: positional PM2.5 lags per entity over all batches, whatever the order of arrival."""
    path, ckpt = S.sink_dirs(spark, "state-lag")
    stream = S.event_stream(spark, sf).select("obs_id", "city", "timestamp", "pm2_5")
    S.run_available(S.append_lags(stream, path, ckpt))
    return S.read_lags(spark, path)


SQL["stream_state_lag"] = O.with_views(["obs"], """
SELECT obs_id, city, "timestamp", lag(pm2_5, 1) OVER w AS lag_1, lag(pm2_5, 3) OVER w AS lag_3, lag(pm2_5, 24) OVER w AS lag_24
FROM obs WINDOW w AS (PARTITION BY city ORDER BY "timestamp", obs_id)""")

QUERIES.update({
    "stream_dedup_first": stream_dedup_first, "stream_dedup_last": stream_dedup_last,
    "stream_bucket_3h": stream_bucket_3h, "stream_latest": stream_latest, "stream_rejects": stream_rejects,
    "stream_dead_letters": stream_dead_letters, "stream_quality_counts": stream_quality_counts,
    "stream_state_lag": stream_state_lag,
})
