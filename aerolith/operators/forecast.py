"""Recursive multi-step forecasting (TS2-TS7, SC13, JN5 tagging).

State per entity is exactly 24 hourly values (hours ft-24 .. ft-1). After a
prediction ``p`` at ft the three hours ft, ft+1, ft+2 all equal ``p`` (the
persistence fill between 3-hour steps), so the next state is
``concat(slice(h, 4, 21), [p, p, p])``. The whole 24-step recursion for one
entity is one ``aggregate(sequence(1, steps), ...)`` expression: no join,
shuffle or projection per step, and all entities run in the same Spark job
(one row per entity, partitioned like any other table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.aqi import alert_level, aqi_category, health_guidance
from aerolith.functions.calendar import calendar_columns

FORECAST_STEPS = 24
STEP_HOURS = 3
STATE_HOURS = 24
METHOD = "recursive_multi_step"
CALENDAR_INPUTS = ["hour", "day", "month", "is_weekend"]


def fit_roll3_linear(train: DataFrame, y: str = "target_aqi", x: str = "aqi_roll_3", digits: int = 6) -> DataFrame:
    """Closed-form least squares ``y ~ alpha + beta * x`` from two aggregates (one row)."""
    return train.agg(F.round(F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double")), digits).alias("alpha"),
                     F.round(F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double")), digits).alias("beta"))


def seed_state(grid: DataFrame, key: str = "city", ts: str = "timestamp", value: str = "us_aqi") -> DataFrame:
    """Initial state: the last 22 hourly grid values plus two copies of the last value.

    Per entity this reads a bounded tail (22 rows) of its hourly grid.
    Entities with fewer than 22 grid hours, or without a value in one of them, are left out
    (coverage gate); ``forecast_rejects`` reports them.
    """
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    tail = grid.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= STATE_HOURS - 2)
    agg = tail.groupBy(key).agg(
        F.max(ts).alias("last_timestamp"),
        F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(value).cast("double").alias("v"))))
        .alias("_pts"))
    h22 = F.transform("_pts", lambda s: s["v"])
    last = F.element_at(h22, -1)
    complete = F.size(F.filter("_pts", lambda s: s["v"].isNotNull())) == STATE_HOURS - 2
    return agg.filter(complete).select(
        key, "last_timestamp", F.concat(h22, F.array(last, last)).alias("state"))


def forecast_rejects(entities: DataFrame, series: DataFrame, key: str = "city", ts: str = "timestamp",
                     value: str = "us_aqi", held: list[str] = ()) -> DataFrame:
    """TS6: entities that cannot be forecast: key, grid hours, reason.

    NO_DATA: no timed row; TOO_FEW_HOURS: the grid is shorter than the state; MISSING_VALUE: the
    first value lies inside the last 22 grid hours, or there is none; MISSING_INPUT: no row has all of the
    ``held`` inputs. Forward fill leaves gaps only before the first value, so one aggregate over the series
    tells all four without a grid.
    """
    hour = F.date_trunc("hour", F.col(ts)).cast("timestamp_ntz")
    spans = series.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(key).agg(
        F.min(hour).alias("_lo"), F.min(F.when(F.col(value).isNotNull(), hour)).alias("_first"), F.max(hour).alias("_hi"),
        F.count_if(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in held) or "true")).alias("_held"))
    length = lambda lo: F.coalesce(F.timestamp_diff("HOUR", F.col(lo), F.col("_hi")) + 1, F.lit(0)).cast("bigint")
    need = STATE_HOURS - 2
    out = entities.select(key).filter(F.col(key).isNotNull()).distinct().join(spans, key, "left").select(
        key, length("_lo").alias("hours"), length("_first").alias("_known"), F.coalesce("_held", F.lit(0)).alias("_held"))
    reason = (F.when(F.col("hours") == 0, F.lit("NO_DATA")).when(F.col("hours") < need, F.lit("TOO_FEW_HOURS"))
              .when(F.col("_known") < need, F.lit("MISSING_VALUE")).otherwise(F.lit("MISSING_INPUT")))
    return out.filter((F.col("_known") < need) | (F.col("_held") == 0)).select(key, "hours", reason.alias("reason"))


def roll3_linear_step(alpha: Column, beta: Column):
    """Model step for the closed-form model: prediction from the 24-hour state, clipped to [0, 500]."""
    def step(h: Column, _i: Column) -> Column:
        roll3 = (F.element_at(h, 22) + F.element_at(h, 23) + F.element_at(h, 24)) / F.lit(3.0)
        return F.least(F.greatest(alpha + beta * roll3, F.lit(0.0)), F.lit(500.0))
    return step


def held_row(series: DataFrame, columns: list[str], key: str = "city", ts: str = "timestamp") -> DataFrame:
    """TS5: the inputs held over the horizon: ``columns`` of each entity's latest row that has them all."""
    last = F.max_by(F.struct(*columns), F.struct(F.col(ts), *columns))
    return series.dropna(subset=[key, ts, *columns]).groupBy(key).agg(last.alias("_h")).select(key, "_h.*")


def step_inputs(h: Column, at: Column, held: list[str]) -> dict[str, Column]:
    """TS3/TS7: the full model input at forecast time ``at``: held columns, calendar of ``at``, lags and means of the state ``h``."""
    mean_last = lambda k: F.aggregate(F.slice(h, STATE_HOURS + 1 - k, k), F.lit(0.0), lambda a, x: a + x) / F.lit(float(k))
    calendar = calendar_columns(at)
    return {
        **{c: F.col(c) for c in held}, **{c: calendar[c] for c in CALENDAR_INPUTS}, "us_aqi": F.element_at(h, STATE_HOURS),
        **{f"aqi_lag_{k}": F.element_at(h, STATE_HOURS + 1 - k) for k in (1, 3, 6, 24)},
        **{f"aqi_roll_{k}": mean_last(k) for k in (3, 6, 24)},
    }


def fit_averaged_linear(train: DataFrame, features: list[str], y: str = "target_aqi", digits: int = 8) -> DataFrame:
    """Mean of the one-feature least-squares models of all ``features``, from one aggregation: one row (intercept, weights).

    A feature without variance (or without values) adds the mean of ``y``.
    """
    k, target = len(features), f"double({y})"
    slope = lambda f: f"coalesce(regr_slope({target}, double({f})), 0D)"
    base = " + ".join(f"coalesce(regr_intercept({target}, double({f})), avg({target}))" for f in features)
    return train.agg(F.expr(f"round(({base}) / {k}, {digits})").alias("intercept"),
                     F.expr(f"array({', '.join(f'round({slope(f)} / {k}, {digits})' for f in features)})").alias("weights"))


def linear_step(intercept: Column, weights: list[Column], features: list[str], held: list[str]):
    """Model step for a linear model over the full input, clipped to [0, 500]; the calendar follows the step."""
    def step(h: Column, i: Column) -> Column:
        at = F.col("last_timestamp") + F.make_dt_interval(F.lit(0), i * F.lit(STEP_HOURS))
        x = step_inputs(h, at, held)
        y = intercept
        for w, f in zip(weights, features):
            y = y + w * x[f].cast("double")
        return F.least(F.greatest(y, F.lit(0.0)), F.lit(500.0))
    return step


def recursive_forecast(seeds: DataFrame, step_fn, steps: int = FORECAST_STEPS, key: str = "city",
                       extra_cols=()) -> DataFrame:
    """TS3/TS4/TS5: run the recursion (persistence fill between steps) and return one row per (entity, step).

    ``step_fn(state, step)`` gives the prediction of a step (from 1) as a column over the seed's columns.
    """
    init = F.struct(F.col("state").alias("h"), F.array().cast("array<double>").alias("preds"))

    def merge(acc, i):
        p = step_fn(acc["h"], i)
        return F.struct(F.concat(F.slice(acc["h"], 4, STATE_HOURS - 3), F.array(p, p, p)).alias("h"),
                        F.concat(acc["preds"], F.array(p)).alias("preds"))

    run = seeds.select(key, "last_timestamp", *extra_cols,
                       F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, merge)["preds"].alias("_preds"))
    rows = run.select(key, "last_timestamp", *extra_cols, F.posexplode("_preds").alias("_pos", "_p"))
    step = (F.col("_pos") + 1).cast("int")
    hours = step * F.lit(STEP_HOURS)
    return rows.select(
        key,
        (F.col("last_timestamp") + F.make_dt_interval(F.lit(0), hours)).alias("timestamp"),
        step.alias("forecast_step"), hours.cast("int").alias("hours_ahead"),
        F.bround("_p", 2).alias("predicted_aqi"), *extra_cols)


def label_forecast(fc: DataFrame, model: str, version: str) -> DataFrame:
    """TS5/TS6: add category, alert, guidance, model identity and method to forecast rows."""
    return fc.withColumns({
        "aqi_category": aqi_category("predicted_aqi"),
        "alert_level": alert_level("predicted_aqi"),
        "health_guidance": health_guidance("predicted_aqi", "forecast"),
        "model": F.lit(model),
        "model_version": F.lit(version),
        "forecast_method": F.lit(METHOD),
    })


def future_calendar(fc: DataFrame, ts: str = "timestamp") -> DataFrame:
    """TS2: calendar features recomputed at each forecast timestamp."""
    return fc.withColumns(calendar_columns(ts))


def forecast_checks(fc: DataFrame, key: str = "city") -> DataFrame:
    """DQ16 + shape checks: per entity 24 rows, steps 1..24, hours 3..72, 0 <= aqi <= 500, one source."""
    return fc.groupBy(key).agg(
        F.count(F.lit(1)).alias("points"),
        F.min("forecast_step").alias("min_step"), F.max("forecast_step").alias("max_step"),
        F.min("hours_ahead").alias("min_hours"), F.max("hours_ahead").alias("max_hours"),
        F.count_if((F.col("predicted_aqi") < 0) | (F.col("predicted_aqi") > 500)).alias("out_of_range"),
        F.count_distinct("data_source").alias("sources"),
    ).withColumn("valid", (F.col("points") == FORECAST_STEPS) & (F.col("min_step") == 1)
                 & (F.col("max_step") == FORECAST_STEPS) & (F.col("min_hours") == STEP_HOURS)
                 & (F.col("max_hours") == FORECAST_STEPS * STEP_HOURS) & (F.col("out_of_range") == 0)
                 & (F.col("sources") == 1))
