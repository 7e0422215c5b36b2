"""Registered queries: hourly grid, as-of lookup, time-range mean, source preference and the
recursive forecast with its insight tables (TS1-TS7, JN4, JN5, WN6, WN10, DQ16, DQ17, AG12, AG13, IN1-IN5, IN7, SO5, SO6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import features as FE
from aerolith.operators import forecast as FC
from aerolith.operators import insights as IN
from aerolith.operators import timeseries as TS
from aerolith.plans import oracle as O
from aerolith.plans.q_monitoring import TRAIN_SQL
from aerolith.session import cut_lineage
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}
MODEL_NAME, MODEL_VERSION = "linear_roll3", "v1"
#: inputs held at the latest row, and all inputs of the full model
HELD = ["pm2_5", "pm10", "temperature"]
FULL_INPUTS = HELD + FC.CALENDAR_INPUTS + ["us_aqi", "aqi_lag_1", "aqi_lag_3", "aqi_lag_6", "aqi_lag_24",
                                           "aqi_roll_3", "aqi_roll_6", "aqi_roll_24"]


def hourly_grid_ffill(spark, sf):
    return TS.hourly_grid(FX.series(spark, sf).select("city", "timestamp", "us_aqi"))


GRID_SQL = """SELECT g.city, g.ts AS "timestamp",
  last_value(s.us_aqi IGNORE NULLS) OVER (PARTITION BY g.city ORDER BY g.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS us_aqi,
  s.city IS NOT NULL AS observed
FROM (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
      FROM (SELECT city, min("timestamp") AS lo, max("timestamp") AS hi FROM series GROUP BY city)) g
LEFT JOIN series s ON s.city = g.city AND s."timestamp" = g.ts"""
SQL["hourly_grid_ffill"] = O.with_views(["series"], GRID_SQL)


def asof_lookup(spark, sf):
    probes = FX.obs(spark, sf).select(F.col("obs_id").alias("probe_id"), "city",
                                      (F.col("timestamp") - F.expr("INTERVAL 90 MINUTES")).alias("probe_ts"))
    return TS.asof_lookup(probes, cut_lineage(FX.series(spark, sf)), "city", "probe_ts", "probe_id")   # read in two branches


SQL["asof_lookup"] = O.with_views(["obs", "series"], """
WITH p AS (SELECT obs_id AS probe_id, city, "timestamp" - INTERVAL 90 MINUTE AS probe_ts FROM obs)
SELECT p.probe_id, p.city, p.probe_ts, coalesce(a.us_aqi, f.first_v) AS asof_value
FROM p ASOF LEFT JOIN series a ON p.city = a.city AND p.probe_ts >= a."timestamp"
LEFT JOIN (SELECT city, arg_min(us_aqi, "timestamp") AS first_v FROM series GROUP BY city) f ON f.city = p.city""")


def time_range_mean(spark, sf):
    g = hourly_grid_ffill(spark, sf)
    out = TS.time_range_mean(g, 24, name="mean_24h")
    return out.select("city", "timestamp", "us_aqi", F.round("mean_24h", 6).alias("mean_24h"))


SQL["time_range_mean"] = O.with_views(["series"], """
SELECT city, "timestamp", us_aqi, round(coalesce(
  avg(us_aqi) OVER (PARTITION BY city ORDER BY "timestamp" RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING),
  lag(us_aqi) OVER (PARTITION BY city ORDER BY "timestamp")), 6) AS mean_24h FROM grid""", [("grid", GRID_SQL)])


def source_preference(spark, sf):
    rt, hist = FX.series_halves(spark, sf, cut_lineage(FX.series(spark, sf)))
    chosen = TS.source_preference(rt, hist)
    return chosen.groupBy("city", "data_source").agg(
        F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"))


CHOSEN_VIEWS = [
    ("cov", """SELECT city FROM series_rt GROUP BY city
        HAVING (epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 3.6e9 >= 24.0
          AND first(us_aqi ORDER BY "timestamp" DESC) IS NOT NULL"""),
    ("chosen", """SELECT city, "timestamp", us_aqi, 'REALTIME' AS data_source FROM series_rt WHERE city IN (SELECT city FROM cov)
        UNION ALL SELECT city, "timestamp", us_aqi, 'HISTORICAL_FALLBACK' FROM series_hist WHERE city NOT IN (SELECT city FROM cov)"""),
]
SQL["source_preference"] = O.with_views(["series_rt", "series_hist"], """
SELECT city, data_source, count(*) AS rows, min("timestamp") AS first_timestamp, max("timestamp") AS last_timestamp
FROM chosen GROUP BY city, data_source""", CHOSEN_VIEWS)


def forecast_table(spark, sf, hourly=None):
    """TS6: source selection -> hourly grid -> seed state -> 24-step recursion -> labels, all entities at once.

    The hourly series feeds every branch (source choice, grid, seeds, model
    fit) under different column prunings, which exchange reuse cannot merge;
    it is materialised once (reliable checkpoint) so the raw observations are
    scanned and scored once.
    """
    hourly = hourly if hourly is not None else cut_lineage(FX.series(spark, sf))
    rt, hist = FX.series_halves(spark, sf, hourly)
    chosen = TS.source_preference(rt, hist)
    sources = chosen.select("city", "data_source").distinct()
    grid = TS.hourly_grid(chosen.select("city", "timestamp", "us_aqi"))
    seeds = FC.seed_state(grid).join(sources, "city")
    model = FC.fit_roll3_linear(FE.drop_incomplete(FX.feats(spark, sf, hourly)))
    # model coefficients enter as scalar subqueries in a projection (lambdas may not hold subqueries)
    coef = model.select(F.struct("alpha", "beta")).scalar()
    seeds = seeds.withColumn("_coef", coef).withColumns({"_alpha": F.col("_coef.alpha"), "_beta": F.col("_coef.beta")})
    step = FC.roll3_linear_step(F.col("_alpha"), F.col("_beta"))
    fc = FC.recursive_forecast(seeds, step, extra_cols=["data_source"])
    return FC.label_forecast(fc, MODEL_NAME, MODEL_VERSION)


def forecast_rejects(spark, sf):
    """TS6: stations whose observations do not suffice for a forecast, with the reason."""
    scored = FX.scored(spark, sf)
    return FC.forecast_rejects(scored, scored, "station_id")


SQL["forecast_rejects"] = O.with_views(["scored"], """
SELECT station_id, CASE WHEN hi IS NULL THEN 0 ELSE date_diff('hour', lo, hi) + 1 END::BIGINT AS hours,
  CASE WHEN hi IS NULL THEN 'NO_DATA' WHEN date_diff('hour', lo, hi) + 1 < 22 THEN 'TOO_FEW_HOURS' ELSE 'MISSING_VALUE' END AS reason
FROM (SELECT station_id, date_trunc('hour', min("timestamp")) AS lo, date_trunc('hour', max("timestamp")) AS hi,
    date_trunc('hour', min("timestamp") FILTER (WHERE us_aqi IS NOT NULL)) AS first_known
  FROM scored WHERE station_id IS NOT NULL GROUP BY station_id)
WHERE first_known IS NULL OR date_diff('hour', first_known, hi) + 1 < 22""")


def _stations(spark, sf):
    """Scored observations of stations; every seventh station never has a temperature."""
    return FX.scored(spark, sf).withColumn("temperature", F.when(F.col("station_id") % 7 != 0, F.col("temperature")))


def forecast_accounting(spark, sf):
    """TS6: every station once: forecast with the full input, or the reason why not."""
    s = _stations(spark, sf)
    seeds = FC.seed_state(TS.hourly_grid(s, key="station_id"), key="station_id").join(FC.held_row(s, HELD, key="station_id"), "station_id")
    done = seeds.select("station_id", F.lit("FORECAST").alias("outcome"))
    return done.unionByName(FC.forecast_rejects(s, s, "station_id", held=HELD).select("station_id", F.col("reason").alias("outcome")))


SQL["forecast_accounting"] = O.with_views(["scored"], """
SELECT station_id, CASE WHEN hi IS NULL THEN 'NO_DATA' WHEN date_diff('hour', lo, hi) + 1 < 22 THEN 'TOO_FEW_HOURS'
  WHEN first_known IS NULL OR date_diff('hour', first_known, hi) + 1 < 22 THEN 'MISSING_VALUE' WHEN held = 0 THEN 'MISSING_INPUT' ELSE 'FORECAST' END AS outcome
FROM (SELECT station_id, date_trunc('hour', min("timestamp")) AS lo, date_trunc('hour', max("timestamp")) AS hi,
    date_trunc('hour', min("timestamp") FILTER (WHERE us_aqi IS NOT NULL)) AS first_known,
    count(*) FILTER (WHERE station_id % 7 <> 0 AND pm2_5 IS NOT NULL AND pm10 IS NOT NULL AND temperature IS NOT NULL) AS held
  FROM scored WHERE station_id IS NOT NULL GROUP BY station_id)""")

FORECAST_VIEWS = CHOSEN_VIEWS + [
    ("train", TRAIN_SQL),
    ("fgrid", """SELECT g.city, g.ts, last_value(c.us_aqi IGNORE NULLS) OVER (PARTITION BY g.city ORDER BY g.ts
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
        FROM (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
              FROM (SELECT city, min("timestamp") AS lo, max("timestamp") AS hi FROM chosen GROUP BY city)) g
        LEFT JOIN chosen c ON c.city = g.city AND c."timestamp" = g.ts"""),
    ("tail", """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY ts DESC) AS rk FROM fgrid) WHERE rk <= 22"""),
    ("seeds", """SELECT s.city, s.last_ts, list_concat(s.h22, [s.h22[22], s.h22[22]]) AS h0, src.data_source
        FROM (SELECT city, max(ts) AS last_ts, list(CAST(v AS DOUBLE) ORDER BY ts) AS h22 FROM tail GROUP BY city HAVING count(*) = 22) s
        JOIN (SELECT DISTINCT city, data_source FROM chosen) src USING (city)"""),
    ("model", """SELECT round(regr_intercept(target_aqi, aqi_roll_3), 6) AS alpha, round(regr_slope(target_aqi, aqi_roll_3), 6) AS beta FROM train"""),
    ("rec", """SELECT city, last_ts, data_source, 0 AS step, h0 AS h, NULL::DOUBLE AS p FROM seeds
        UNION ALL
        SELECT city, last_ts, data_source, step + 1,
          list_concat(h[4:24], [least(greatest(alpha + beta * ((h[22] + h[23] + h[24]) / 3.0), 0.0), 500.0),
                                least(greatest(alpha + beta * ((h[22] + h[23] + h[24]) / 3.0), 0.0), 500.0),
                                least(greatest(alpha + beta * ((h[22] + h[23] + h[24]) / 3.0), 0.0), 500.0)]),
          least(greatest(alpha + beta * ((h[22] + h[23] + h[24]) / 3.0), 0.0), 500.0)
        FROM rec, model WHERE step < 24"""),
    ("fc0", """SELECT city, last_ts + to_hours(step * 3) AS "timestamp", step AS forecast_step, step * 3 AS hours_ahead,
        round_even(p, 2) AS predicted_aqi, data_source FROM rec WHERE step >= 1"""),
    ("fc", f"""SELECT *, {O.category_sql('predicted_aqi')} AS aqi_category, {O.alert_sql('predicted_aqi')} AS alert_level,
        {O.guidance_sql('predicted_aqi', 'forecast')} AS health_guidance, '{MODEL_NAME}' AS model,
        '{MODEL_VERSION}' AS model_version, '{FC.METHOD}' AS forecast_method FROM fc0"""),
]


def _fc_sql(body: str, extra=()) -> str:
    return O.with_views(["feats", "series_rt", "series_hist"], body, FORECAST_VIEWS + list(extra), recursive=True)


def forecast_recursive(spark, sf):
    return forecast_table(spark, sf)


SQL["forecast_recursive"] = _fc_sql("SELECT * FROM fc")


def forecast_checks(spark, sf):
    return FC.forecast_checks(forecast_table(spark, sf))


SQL["forecast_checks"] = _fc_sql("""
SELECT city, count(*) AS points, min(forecast_step) AS min_step, max(forecast_step) AS max_step, min(hours_ahead) AS min_hours,
  max(hours_ahead) AS max_hours, count(*) FILTER (WHERE predicted_aqi < 0 OR predicted_aqi > 500) AS out_of_range,
  count(DISTINCT data_source) AS sources,
  count(*) = 24 AND min(forecast_step) = 1 AND max(forecast_step) = 24 AND min(hours_ahead) = 3 AND max(hours_ahead) = 72
    AND count(*) FILTER (WHERE predicted_aqi < 0 OR predicted_aqi > 500) = 0 AND count(DISTINCT data_source) = 1 AS valid
FROM fc GROUP BY city""")


def forecast_calendar(spark, sf):
    """TS2: calendar features at each forecast timestamp."""
    return FC.future_calendar(forecast_table(spark, sf)).select(
        "city", "forecast_step", "hour", "day", "month", "year", "day_of_week", "is_weekend", "season")


SQL["forecast_calendar"] = _fc_sql(f'SELECT city, forecast_step, {O.calendar_sql()} FROM fc')


def full_seeds(spark, sf, hourly):
    """Seed state, data source and held row per entity, from the materialised hourly series."""
    chosen = TS.source_preference(*FX.series_halves(spark, sf, hourly, HELD))
    seeds = FC.seed_state(TS.hourly_grid(chosen.select("city", "timestamp", "us_aqi")))
    return seeds.join(FC.held_row(chosen, ["data_source", *HELD]), "city")


_X = {**{c: c for c in HELD}, "hour": "hour(ft)", "day": "day(ft)", "month": "month(ft)", "is_weekend": "CAST(isodow(ft) >= 6 AS INTEGER)",
      "us_aqi": "h[24]", "aqi_lag_1": "h[24]", "aqi_lag_3": "h[22]", "aqi_lag_6": "h[19]", "aqi_lag_24": "h[1]",
      "aqi_roll_3": "list_sum(h[22:24]) / 3.0", "aqi_roll_6": "list_sum(h[19:24]) / 6.0", "aqi_roll_24": "list_sum(h) / 24.0"}
FULL_VIEWS = [
    ("full_seeds", """SELECT s.*, x.v.pm2_5, x.v.pm10, x.v.temperature FROM seeds s
        JOIN (SELECT city, arg_max({'pm2_5': pm2_5, 'pm10': pm10, 'temperature': temperature}, "timestamp") AS v FROM series
          WHERE pm2_5 IS NOT NULL AND pm10 IS NOT NULL AND temperature IS NOT NULL GROUP BY city) x ON x.city = s.city"""),
    ("full_model", "SELECT round((" + " + ".join(f"CASE WHEN min({f}) < max({f}) THEN regr_intercept(target_aqi, {f}) ELSE avg(target_aqi) END" for f in FULL_INPUTS)
     + f") / {len(FULL_INPUTS)}, 8) AS b, " + ", ".join(f"round(CASE WHEN min({f}) < max({f}) THEN regr_slope(target_aqi, {f}) ELSE 0.0 END / {len(FULL_INPUTS)}, 8) AS w_{f}" for f in FULL_INPUTS)
     + " FROM train"),
    ("full_rec", """SELECT city, last_ts, data_source, pm2_5, pm10, temperature, 0 AS step, h0 AS h, NULL::DOUBLE AS p FROM full_seeds
        UNION ALL
        SELECT city, last_ts, data_source, pm2_5, pm10, temperature, step + 1, list_concat(h[4:24], [y, y, y]), y
        FROM (SELECT r.*, least(greatest(b + """ + " + ".join(f"w_{f} * ({x})" for f, x in _X.items()) + """, 0.0), 500.0) AS y
          FROM (SELECT *, last_ts + to_hours((step + 1) * 3) AS ft FROM full_rec WHERE step < 24) r, full_model)"""),
]


def next_step_input(spark, sf):
    """TS7: first-step model input (held row, calendar and state features at ft = last + 3 h) per entity."""
    seeds = full_seeds(spark, sf, cut_lineage(FX.series(spark, sf)))
    at = F.col("last_timestamp") + F.expr("INTERVAL 3 HOURS")
    x = FC.step_inputs(F.col("state"), at, HELD)
    return seeds.select("city", at.alias("timestamp"), *[
        (F.round(x[f], 6) if f.startswith("aqi_roll") else x[f]).alias(f) for f in FULL_INPUTS])


SQL["next_step_input"] = _fc_sql("""
SELECT city, last_ts + INTERVAL 3 HOUR AS "timestamp", pm2_5, pm10, temperature, hour(last_ts + INTERVAL 3 HOUR) AS hour,
  day(last_ts + INTERVAL 3 HOUR) AS day, month(last_ts + INTERVAL 3 HOUR) AS month,
  CAST(isodow(last_ts + INTERVAL 3 HOUR) >= 6 AS BIGINT) AS is_weekend, h0[24] AS us_aqi, h0[24] AS aqi_lag_1, h0[22] AS aqi_lag_3,
  h0[19] AS aqi_lag_6, h0[1] AS aqi_lag_24, round(list_sum(h0[22:24]) / 3.0, 6) AS aqi_roll_3,
  round(list_sum(h0[19:24]) / 6.0, 6) AS aqi_roll_6, round(list_sum(h0) / 24.0, 6) AS aqi_roll_24 FROM full_seeds""", FULL_VIEWS[:1])


def forecast_full(spark, sf):
    """TS5: recursion with the full model input: pollutants and weather held at the latest row, calendar of each step, state."""
    hourly = cut_lineage(FX.series(spark, sf))
    model = FC.fit_averaged_linear(FE.drop_incomplete(FX.feats(spark, sf, hourly)), FULL_INPUTS)
    seeds = full_seeds(spark, sf, hourly).withColumn("_m", model.select(F.struct("intercept", "weights")).scalar())
    weights = [F.col("_m.weights")[i] for i in range(len(FULL_INPUTS))]
    step = FC.linear_step(F.col("_m.intercept"), weights, FULL_INPUTS, HELD)
    return FC.label_forecast(FC.recursive_forecast(seeds, step, extra_cols=["data_source"]), "linear_full", "v1")


SQL["forecast_full"] = _fc_sql(f"""SELECT *, {O.category_sql('predicted_aqi')} AS aqi_category, {O.alert_sql('predicted_aqi')} AS alert_level,
  {O.guidance_sql('predicted_aqi', 'forecast')} AS health_guidance, 'linear_full' AS model, 'v1' AS model_version,
  '{FC.METHOD}' AS forecast_method
FROM (SELECT city, last_ts + to_hours(step * 3) AS "timestamp", step AS forecast_step, step * 3 AS hours_ahead,
  round_even(p, 2) AS predicted_aqi, data_source FROM full_rec WHERE step >= 1)""", FULL_VIEWS)


def forecast_summary(spark, sf):
    return IN.forecast_summary(forecast_table(spark, sf))


SQL["forecast_summary"] = _fc_sql("""
SELECT city, round_even(avg(predicted_aqi), 2) AS avg_aqi, max(predicted_aqi) AS max_aqi, min(predicted_aqi) AS min_aqi,
  count(*) AS points FROM fc GROUP BY city""")


def daily_forecast(spark, sf):
    return IN.daily_forecast(forecast_table(spark, sf))


SQL["daily_forecast"] = _fc_sql("""
SELECT city, strftime("timestamp", '%Y-%m-%d') AS date, round_even(avg(predicted_aqi), 2) AS avg_aqi,
  min(predicted_aqi) AS min_aqi, max(predicted_aqi) AS max_aqi FROM fc GROUP BY ALL""")


def nearest_horizon(spark, sf):
    return IN.nearest_horizon(forecast_table(spark, sf), [24, 48, 72])


SQL["nearest_horizon"] = _fc_sql("""
SELECT city, arg_min(predicted_aqi, (abs(hours_ahead - 24), hours_ahead)) AS aqi_24h,
  arg_min(predicted_aqi, (abs(hours_ahead - 48), hours_ahead)) AS aqi_48h,
  arg_min(predicted_aqi, (abs(hours_ahead - 72), hours_ahead)) AS aqi_72h FROM fc GROUP BY city""")


def alerts(spark, sf):
    return IN.smart_alerts(forecast_table(spark, sf))


SQL["alerts"] = _fc_sql(f"""
WITH pk AS (SELECT city, arg_max("timestamp", (predicted_aqi, -forecast_step)) AS peak_ts, max(predicted_aqi) AS peak_aqi,
    arg_min("timestamp", (predicted_aqi, forecast_step)) AS min_ts, min(predicted_aqi) AS min_aqi FROM fc GROUP BY city)
SELECT city, peak_aqi,
  CASE WHEN peak_aqi > 150 THEN 'danger' WHEN peak_aqi > 100 THEN 'warning' ELSE 'success' END AS peak_severity,
  CASE WHEN peak_aqi > 150 THEN 'High AQI Alert' WHEN peak_aqi > 100 THEN 'Sensitive Group Alert' ELSE 'Air Quality Outlook' END AS peak_title,
  CASE WHEN peak_aqi > 150 THEN 'AQI may reach ' || CAST(CAST(round_even(peak_aqi, 0) AS BIGINT) AS VARCHAR) || ' around ' || strftime(peak_ts, '%a %d %b, %I:%M %p') || '. Plan important outdoor activities for a cleaner period.'
       WHEN peak_aqi > 100 THEN 'AQI may reach ' || CAST(CAST(round_even(peak_aqi, 0) AS BIGINT) AS VARCHAR) || ' around ' || strftime(peak_ts, '%a %d %b, %I:%M %p') || '. Sensitive people should reduce prolonged outdoor exposure.'
       ELSE 'No unhealthy AQI period is predicted in the current 72-hour forecast.' END AS peak_message,
  min_aqi, CASE WHEN min_aqi <= 100 THEN 'success' ELSE 'warning' END AS best_severity,
  'The cleanest forecast point is ' || strftime(min_ts, '%a %d %b, %I:%M %p') || ' with AQI near '
    || CAST(CAST(round_even(min_aqi, 0) AS BIGINT) AS VARCHAR) || ' (' || ({O.category_sql('min_aqi')}) || ').' AS best_message
FROM pk""")


def activity_windows(spark, sf):
    return IN.activity_windows(forecast_table(spark, sf), limit=8)


SQL["activity_windows"] = _fc_sql(f"""
SELECT city, rank, strftime("timestamp", '%a %d %b, %I:%M %p') AS recommended_time,
  CAST(round_even(predicted_aqi, 0) AS BIGINT) AS forecast_aqi, {O.category_sql('predicted_aqi')} AS aqi_category,
  {O.activity_level_sql('predicted_aqi')} AS activity_advice
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY predicted_aqi, "timestamp") AS BIGINT) AS rank FROM fc)
WHERE rank <= 8""")


def entity_comparison(spark, sf):
    return IN.entity_comparison(forecast_table(spark, sf))


SQL["entity_comparison"] = _fc_sql(f"""
WITH c AS (SELECT city, arg_min(predicted_aqi, forecast_step) AS next_aqi,
    avg(predicted_aqi) FILTER (WHERE hours_ahead <= 24) AS avg_24h, avg(predicted_aqi) AS avg_72h,
    max(predicted_aqi) AS peak_72h, any_value(data_source) AS data_source FROM fc GROUP BY city)
SELECT CAST(row_number() OVER (ORDER BY avg_24h, city) AS BIGINT) AS rank, city, round_even(next_aqi, 1) AS next_aqi,
  round_even(avg_24h, 1) AS avg_24h, round_even(avg_72h, 1) AS avg_72h, round_even(peak_72h, 1) AS peak_72h,
  {O.category_sql('next_aqi')} AS aqi_category, data_source FROM c""")


def best_worst_entity(spark, sf):
    """SO6: cleanest and most polluted entity by 24 h average."""
    cmp = IN.entity_comparison(forecast_table(spark, sf))
    return cmp.agg(F.min_by("city", F.struct("avg_24h", "city")).alias("best_entity"),
                   F.max_by("city", F.struct("avg_24h", F.lit(0) - F.col("rank"))).alias("worst_entity"))


SQL["best_worst_entity"] = _fc_sql("""
WITH c AS (SELECT city, round_even(avg(predicted_aqi) FILTER (WHERE hours_ahead <= 24), 1) AS avg_24h,
    avg(predicted_aqi) FILTER (WHERE hours_ahead <= 24) AS raw24 FROM fc GROUP BY city),
r AS (SELECT *, row_number() OVER (ORDER BY raw24, city) AS rank FROM c)
SELECT arg_min(city, (avg_24h, city)) AS best_entity, arg_max(city, (avg_24h, -rank)) AS worst_entity FROM r""")


def hazardous_forecast(spark, sf):
    """DQ17: forecast rows in an alert level (Warning and above) or hazardous (> 300)."""
    fc = forecast_table(spark, sf)
    return fc.filter(F.col("alert_level").isin("Warning", "High Alert", "Emergency") | (F.col("predicted_aqi") > 300)) \
        .select("city", "forecast_step", "predicted_aqi", "alert_level", (F.col("predicted_aqi") > 300).alias("hazardous"))


SQL["hazardous_forecast"] = _fc_sql("""
SELECT city, forecast_step, predicted_aqi, alert_level, predicted_aqi > 300 AS hazardous FROM fc
WHERE alert_level IN ('Warning', 'High Alert', 'Emergency') OR predicted_aqi > 300""")


def serving_health(spark, sf):
    """IN7: row counts and entity counts of the served tables."""
    hourly = cut_lineage(FX.series(spark, sf))
    return IN.serving_health(forecast_table(spark, sf, hourly), *FX.series_halves(spark, sf, hourly))


SQL["serving_health"] = _fc_sql("""
SELECT (SELECT count(*) FROM fc) AS forecast_rows, (SELECT count(DISTINCT city) FROM fc) AS forecast_entities,
  (SELECT count(*) FROM series_rt) AS realtime_rows, (SELECT count(*) FROM series_hist) AS historical_rows,
  (SELECT count(*) FROM (SELECT city FROM series_rt UNION SELECT city FROM series_hist)) AS available_entities""")

QUERIES.update({
    "hourly_grid_ffill": hourly_grid_ffill, "asof_lookup": asof_lookup, "time_range_mean": time_range_mean,
    "source_preference": source_preference, "forecast_recursive": forecast_recursive, "forecast_full": forecast_full, "forecast_rejects": forecast_rejects,
    "forecast_accounting": forecast_accounting,
    "forecast_checks": forecast_checks, "forecast_calendar": forecast_calendar, "next_step_input": next_step_input,
    "forecast_summary": forecast_summary, "daily_forecast": daily_forecast, "nearest_horizon": nearest_horizon,
    "alerts": alerts, "activity_windows": activity_windows, "entity_comparison": entity_comparison,
    "best_worst_entity": best_worst_entity, "hazardous_forecast": hazardous_forecast, "serving_health": serving_health,
})
