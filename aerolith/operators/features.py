"""Feature operators: time buckets, lags, rolling means, targets, sequences (AG1, WN1-WN5, DQ13).

Scale notes
-----------
* ``bucket_mean`` is a hash aggregation on (entity, bucket): Spark combines
  partial averages map-side, so a hot entity is spread over all map tasks and
  the shuffle carries one partial row per (task, entity, bucket).
* All per-entity windows share the *same* ``partitionBy(key).orderBy(ts)``
  spec, so Catalyst plans one Exchange and one Sort for lags, rolling means
  and the target together. They run on bucketed series, where an entity has
  at most one row per bucket, so a window partition is bounded by
  span / grain (10 years hourly = 87 600 rows) no matter how many raw rows the
  entity has. Raw observations are never windowed per entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.calendar import floor_hour, floor_hours
from aerolith.functions.numeric import clean_double

# Numeric columns averaged by the 3-hour aggregation, in order.
BUCKET_NUMERIC_COLUMNS = [
    "latitude", "longitude", "temperature", "humidity", "pressure", "wind_speed",
    "wind_direction", "precipitation", "cloud_cover", "visibility", "pm2_5", "pm10",
    "carbon_monoxide", "nitrogen_monoxide", "nitrogen_dioxide", "ozone",
    "sulphur_dioxide", "ammonia", "openweather_aqi_index", "us_aqi",
]
LAGS = [1, 3, 6, 24]
ROLLS = [3, 6, 24]
HISTORY_FEATURES = [f"aqi_lag_{k}" for k in LAGS] + [f"aqi_roll_{w}" for w in ROLLS]


def _entity_window(key: str | list[str], ts: str) -> Window:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(F.col(ts).asc())


def bucket_mean(df: DataFrame, key: str = "city", ts: str = "timestamp", hours: int = 3,
                columns: list[str] | None = None, round_aqi: bool = True,
                digits: int | None = None) -> DataFrame:
    """AG1: mean of every numeric column per (entity, ``hours``-wide bucket).

    ``us_aqi`` is rounded half-to-even after averaging (AQI is scored per raw
    row first, then averaged). Rows with a NULL entity or time are dropped
    (pandas ``groupby`` drops NULL keys). ``digits`` optionally rounds the
    other means for stable reports. Adds ``n_obs``.
    """
    cols = columns or [c for c in BUCKET_NUMERIC_COLUMNS if c in df.columns]
    bucket = floor_hour(ts) if hours == 1 else floor_hours(ts, hours)
    aggs = []
    for c in cols:
        m = F.avg(clean_double(c))
        if c == "us_aqi" and round_aqi:
            m = F.bround(m, 0)
        elif digits is not None:
            m = F.round(m, digits)
        aggs.append(m.alias(c))
    aggs.append(F.count(F.lit(1)).alias("n_obs"))
    return (df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
            .groupBy(F.col(key), bucket.alias(ts))
            .agg(*aggs))


def lag_columns(value: str, key="city", ts="timestamp", lags=LAGS, prefix="aqi_lag_") -> dict[str, Column]:
    """WN1: positional lags per entity (row k before, regardless of time gaps)."""
    w = _entity_window(key, ts)
    return {f"{prefix}{k}": F.lag(F.col(value), k).over(w) for k in lags}


def rolling_columns(value: str, key="city", ts="timestamp", windows=ROLLS, prefix="aqi_roll_") -> dict[str, Column]:
    """WN2: trailing mean of the last ``w`` rows including the current one.

    NULL unless all ``w`` values are present (pandas ``min_periods=w``).
    """
    out = {}
    for w in windows:
        frame = _entity_window(key, ts).rowsBetween(-(w - 1), Window.currentRow)
        v = F.col(value)
        out[f"{prefix}{w}"] = F.when(F.count(v).over(frame) == w, F.avg(v).over(frame))
    return out


def add_history_features(df: DataFrame, key="city", ts="timestamp", value="us_aqi",
                         lags=LAGS, windows=ROLLS) -> DataFrame:
    """WN1 + WN2 in one projection (one Exchange + Sort on the entity)."""
    cols = {}
    cols.update(lag_columns(value, key, ts, lags))
    cols.update(rolling_columns(value, key, ts, windows))
    return df.filter(F.col(key).isNotNull()).withColumns(cols)


def add_target(df: DataFrame, key="city", ts="timestamp", value="us_aqi", horizon=3,
               name="target_aqi") -> DataFrame:
    """WN3: value ``horizon`` rows ahead within the entity."""
    return df.withColumn(name, F.lead(F.col(value), horizon).over(_entity_window(key, ts)))


def model_ready_flag(columns=HISTORY_FEATURES) -> Column:
    """DQ13: 1 when every history feature is present, else 0."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]).cast("bigint")


def sequences(df: DataFrame, key="city", ts="timestamp", value="us_aqi", length=24,
              keep_incomplete: bool = False) -> DataFrame:
    """WN5: the ``length`` preceding values (oldest first) and the next value as label.

    Bounded frame ``rowsBetween(-length, -1)``; rows without a full history are
    dropped unless ``keep_incomplete``.
    """
    w = _entity_window(key, ts).rowsBetween(-length, -1)
    out = df.withColumn("history", F.collect_list(F.col(value)).over(w))
    out = out.withColumn("label", F.col(value))
    if not keep_incomplete:
        out = out.filter(F.size("history") == length)
    return out


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """DQ6: drop rows with a NULL (or NaN) in any of ``subset`` (all columns by default)."""
    cols = subset or df.columns
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    num = {t for c, t in df.dtypes if c in cols and t in ("double", "float")}
    if num:
        cond = cond & reduce(lambda a, b: a & b,
                             [~F.isnan(F.col(c)) for c, t in df.dtypes if c in cols and t in num])
    return df.filter(cond)
