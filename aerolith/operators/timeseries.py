"""Time-series operators: hourly grid + forward fill, as-of lookup, time-range means,
source preference (TS1, JN4, JN5, WN6, WN10, DQ14).

Skew: per-entity windows here run on hourly grids (one row per entity-hour,
bounded by span / 1 h). The as-of lookup, whose probes can be raw rows of a
hot entity, is chunked by (entity, hour): each chunk is windowed on its own
and the value carried in from earlier chunks comes from a per-(entity, hour)
table of last values, so no task holds all probes of one entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.quality import history_coverage

REALTIME, HISTORICAL = "REALTIME", "HISTORICAL_FALLBACK"


def hourly_grid(series: DataFrame, key: str = "city", ts: str = "timestamp", value: str = "us_aqi") -> DataFrame:
    """TS1 + WN10: gap-free hourly grid from each entity's first to last hour, forward-filled.

    Timestamps are floored to the hour first (observations off the grid are
    not lost). Adds ``observed`` (true where the hour had data).
    """
    s = (series.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
         .select(F.col(key), F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz").alias("_hour"),
                 F.when(F.col(value).isNotNull(), F.col(ts)).alias("_at"), F.col(value))
         .groupBy(key, F.col("_hour").alias(ts)).agg(F.max_by(value, "_at").alias(value)))  # the latest value of the hour
    bounds = s.groupBy(key).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = bounds.select(key, F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias(ts))
    joined = grid.join(s.withColumn("_obs", F.lit(True)), [key, ts], "left")
    w = Window.partitionBy(key).orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.select(key, ts, F.last(value, ignorenulls=True).over(w).alias(value),
                         F.coalesce(F.col("_obs"), F.lit(False)).alias("observed"))


def asof_lookup(probes: DataFrame, history: DataFrame, key: str = "city", probe_ts: str = "probe_ts",
                probe_id: str = "probe_id", ts: str = "timestamp", value: str = "us_aqi",
                chunk: str = "hour") -> DataFrame:
    """JN4: for each probe, the latest history value at or before the probe time, else the entity's first value.

    Adds ``asof_value`` to ``probes`` (all probe columns are kept; ``probe_id``
    is only used to order probes that share a time). History rows with a NULL
    value are ignored.

    Probes and history are unioned and windowed per (entity, ``chunk``): a
    window partition holds one entity-chunk, so a hot entity is spread over
    as many tasks as it has chunks. The value carried into each chunk (last
    history value of earlier chunks, else the entity's first value) comes
    from a table with one row per (entity, chunk). The probe rows carry their
    own columns through the union, so their only join is that carry lookup,
    on the keys the window already partitioned them by. There is no join
    back on a probe id and no join on the entity alone.
    """
    h = history.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).select(
        F.col(key), F.col(ts).alias("_t"), F.col(value).cast("double").alias("_v"))
    carried = [c for c in probes.columns if c != key]
    probe_struct = F.struct(*[F.col(c) for c in carried])
    p_rows = probes.select(F.col(key), F.col(probe_ts).alias("_t"), F.lit(None).cast("double").alias("_v"),
                           F.lit(1).alias("_kind"), F.col(probe_id).alias("_order"), probe_struct.alias("_probe"))
    p_schema = p_rows.schema
    h_rows = h.select(key, "_t", "_v", F.lit(0).alias("_kind"),
                      F.lit(None).cast(p_schema["_order"].dataType).alias("_order"),
                      F.lit(None).cast(p_schema["_probe"].dataType).alias("_probe"))
    rows = p_rows.unionByName(h_rows).withColumn("_chunk", F.date_trunc(chunk, "_t"))
    # one row per (entity, chunk): last history value of the chunk, carried forward across chunks;
    # before the first history value the entity's first value is used
    chunk_ends = h.groupBy(key, F.date_trunc(chunk, "_t").alias("_chunk")).agg(
        F.max_by("_v", "_t").alias("_chunk_last"), F.min_by("_v", "_t").alias("_chunk_first"))
    chunks = rows.select(key, "_chunk").distinct().join(chunk_ends, [key, "_chunk"], "left")
    by_chunk = Window.partitionBy(key).orderBy("_chunk")
    wc = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_chunk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = chunks.select(key, "_chunk", F.coalesce(F.last("_chunk_last", ignorenulls=True).over(wc),
                                                    F.first("_chunk_first", ignorenulls=True).over(whole)).alias("_carry"))
    wi = Window.partitionBy(key, "_chunk").orderBy("_t", "_kind", "_order").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    within = rows.withColumn("_in", F.last("_v", ignorenulls=True).over(wi)).filter(F.col("_kind") == 1)
    res = within.join(carry, [key, "_chunk"], "left")
    out = [F.col(key) if c == key else F.col(f"_probe.{c}").alias(c) for c in probes.columns]
    return res.select(*out, F.coalesce("_in", "_carry").alias("asof_value"))


def time_range_mean(grid: DataFrame, hours: int, key: str = "city", ts: str = "timestamp",
                    value: str = "us_aqi", name: str | None = None) -> DataFrame:
    """WN6: mean over [t - hours, t - 1 h] on the hourly grid; falls back to the previous value."""
    secs = F.unix_seconds(F.col(ts).cast("timestamp"))
    w = Window.partitionBy(key).orderBy(secs).rangeBetween(-hours * 3600, -3600)
    prev = F.lag(value, 1).over(Window.partitionBy(key).orderBy(ts))
    return grid.withColumn(name or f"mean_{hours}h", F.coalesce(F.avg(value).over(w), prev))


def source_preference(realtime: DataFrame, historical: DataFrame, key: str = "city", ts: str = "timestamp",
                      min_hours: float = 24.0, required: list[str] = ("us_aqi",)) -> DataFrame:
    """JN5: per entity, use the real-time series when it covers >= ``min_hours`` and its latest row
    has all ``required`` columns (DQ15), else the historical one.

    Returns the chosen rows with a ``data_source`` column; entities in neither
    source are absent (the caller reports them as rejects).
    """
    latest = realtime.groupBy(key).agg(F.max_by(F.struct(*required), F.struct(F.col(ts), *required)).alias("_r")) \
        .filter(F.expr(" AND ".join(f"_r.`{c}` IS NOT NULL" for c in required) or "true"))
    eligible = history_coverage(realtime, key, ts, min_hours).filter("sufficient").select(key).join(latest, key, "left_semi")
    rt = realtime.join(eligible, key, "left_semi").withColumn("data_source", F.lit(REALTIME))
    hist = historical.join(eligible, key, "left_anti").withColumn("data_source", F.lit(HISTORICAL))
    return rt.unionByName(hist)
