"""Registered queries: backtests, scaling, MLlib training/ranking/persistence and model-driven recursion
(TS8-TS10, ML1-ML10, TS5 with MLlib). MLlib outputs are checked rows-only (no SQL oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import backtest as B
from aerolith.operators import features as FE
from aerolith.operators import forecast as FC
from aerolith.operators import ml as ML
from aerolith.operators import timeseries as TS
from aerolith.operators.monitoring import regression_metrics
from aerolith.plans import oracle as O
from aerolith.plans.q_monitoring import TRAIN_SQL, split_table
from aerolith.plans.q_timeseries import FULL_INPUTS, HELD, full_seeds
from aerolith.session import cut_lineage
from aerolith.sources import fixtures as FX
from aerolith.sources.io import scratch_dir

QUERIES, SQL = {}, {}


def _grid_positions(spark, sf):
    return B.positions(TS.hourly_grid(FX.series(spark, sf).select("city", "timestamp", "us_aqi")))


def baseline_backtest(spark, sf):
    """TS8/AG18: per-entity and pooled metrics of three closed-form baselines."""
    preds = B.baseline_forecasts(_grid_positions(spark, sf))
    return preds.sparkSession.sql("""
        SELECT method, coalesce(city, 'Overall') AS city, count(*) AS samples,
          round(avg(abs(y_hat - y)), 4) AS mae, round(sqrt(avg(pow(y_hat - y, 2))), 4) AS rmse,
          round(1 - try_divide(sum(pow(y_hat - y, 2)), var_pop(y) * count(*)), 4) AS r2
        FROM {preds} WHERE y_hat IS NOT NULL AND y IS NOT NULL
        GROUP BY GROUPING SETS ((method, city), (method))""", preds=preds)


GRID_POS_SQL = [
    ("grid", """SELECT g.city, g.ts AS "timestamp", last_value(s.us_aqi IGNORE NULLS) OVER (PARTITION BY g.city ORDER BY g.ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS us_aqi
      FROM (SELECT city, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts
            FROM (SELECT city, min("timestamp") AS lo, max("timestamp") AS hi FROM series GROUP BY city)) g
      LEFT JOIN series s ON s.city = g.city AND s."timestamp" = g.ts"""),
    ("pos", """SELECT *, pos <= n_train AS is_train FROM (
      SELECT city, "timestamp", CAST(us_aqi AS DOUBLE) AS y, row_number() OVER (PARTITION BY city ORDER BY "timestamp") AS pos,
        count(*) OVER (PARTITION BY city) AS n, CAST(floor(count(*) OVER (PARTITION BY city) * 0.8) AS INTEGER) AS n_train FROM grid)"""),
]
BACKTEST_SQL = GRID_POS_SQL + [
    ("tr", """SELECT *, lag(d) OVER (PARTITION BY city ORDER BY pos) AS d_prev FROM (
      SELECT *, y - lag(y) OVER (PARTITION BY city ORDER BY pos) AS d FROM pos WHERE is_train)"""),
    ("params", """SELECT city, arg_max(y, pos) AS y_T, arg_max(d, pos) AS d_T, round(regr_slope(d, d_prev), 6) AS phi FROM tr GROUP BY city"""),
    ("te", """SELECT p.city, p.pos, p.y, p.pos - p.n_train AS k, p.n_train, pa.y_T, pa.d_T, coalesce(pa.phi, 0.0) AS phi
      FROM pos p JOIN params pa USING (city) WHERE NOT p.is_train"""),
    ("preds", """SELECT te.city, 'persistence' AS method, te.y, te.y_T AS y_hat FROM te
      UNION ALL SELECT te.city, 'seasonal_naive_24', te.y, s.y FROM te
        LEFT JOIN pos s ON s.city = te.city AND s.is_train AND s.pos = te.n_train - 24 + ((te.k - 1) % 24) + 1
      UNION ALL SELECT city, 'ar1_diff', y, y_T + coalesce(d_T, 0.0) *
        CASE WHEN phi = 1.0 THEN CAST(k AS DOUBLE) ELSE phi * (1.0 - pow(phi, k)) / (1.0 - phi) END FROM te"""),
]
SQL["baseline_backtest"] = O.with_views(["series"], """
SELECT method, coalesce(city, 'Overall') AS city, count(*) AS samples, round(avg(abs(y_hat - y)), 4) AS mae,
  round(sqrt(avg(pow(y_hat - y, 2))), 4) AS rmse,
  round(1 - sum(pow(y_hat - y, 2)) / (sum(y * y) - pow(sum(y), 2) / count(*)), 4) AS r2
FROM preds WHERE y_hat IS NOT NULL AND y IS NOT NULL GROUP BY GROUPING SETS ((method, city), (method))""", BACKTEST_SQL)


def backtest_predictions(spark, sf):
    """TS8: the predictions behind the backtest: a row per method, entity and test hour."""
    pos = cut_lineage(_grid_positions(spark, sf))
    preds = B.baseline_forecasts(pos)
    return preds.join(pos.select("city", "pos", "timestamp"), ["city", "pos"]).select(
        "method", "city", "timestamp", (F.col("y")).alias("actual"), F.round("y_hat", 6).alias("predicted"), F.round(F.col("y_hat") - F.col("y"), 6).alias("error"))


SQL["backtest_predictions"] = O.with_views(["series"], """
SELECT p.method, p.city, pos."timestamp", p.y AS actual, round(p.y_hat, 6) AS predicted, round(p.y_hat - p.y, 6) AS error
FROM preds2 p JOIN pos ON pos.city = p.city AND pos.pos = p.pos""", BACKTEST_SQL[:-1] + [("preds2", BACKTEST_SQL[-1][1]
    .replace("SELECT te.city, 'persistence'", "SELECT te.city, te.pos, 'persistence'").replace("SELECT te.city, 'seasonal_naive_24'", "SELECT te.city, te.pos, 'seasonal_naive_24'")
    .replace("SELECT city, 'ar1_diff'", "SELECT city, pos, 'ar1_diff'"))])


def minmax_scaled(spark, sf):
    """TS9: per-entity min-max scaling fitted on the first 80 % of each entity's hours."""
    s = B.minmax_scale(_grid_positions(spark, sf))
    return s.select("city", "timestamp", "is_train", F.round("scaled", 6).alias("scaled"))


SQL["minmax_scaled"] = O.with_views(["series"], """
SELECT p.city, p."timestamp", p.is_train, round(CASE WHEN m.y_max > m.y_min THEN (p.y - m.y_min) / (m.y_max - m.y_min) END, 6) AS scaled
FROM pos p JOIN (SELECT city, min(y) AS y_min, max(y) AS y_max FROM pos WHERE is_train GROUP BY city) m USING (city)""", GRID_POS_SQL)


def sequence_regression(spark, sf):
    """TS10: 24 scaled lags -> next scaled value with one MLlib regressor over all entities; metrics per entity + pooled."""
    scaled = B.minmax_scale(_grid_positions(spark, sf))
    seq = FE.sequences(scaled, key="city", ts="timestamp", value="scaled", length=24)
    vec = ML.sequence_vectors(seq).filter(F.col("label").isNotNull())
    from pyspark.ml.regression import LinearRegression
    lr = LinearRegression(featuresCol="features", labelCol="label", regParam=0.0)
    fitted = lr.fit(vec.filter("is_train"))
    pred = fitted.transform(vec.filter(~F.col("is_train")))
    pred = pred.select("city", "y", B.inverse_scale(F.col("prediction")).alias("y_hat"))
    per = regression_metrics(pred, "y", "y_hat", groups=["city"])
    pooled = regression_metrics(pred, "y", "y_hat").withColumn("city", F.lit("Overall"))
    return per.unionByName(pooled)


def model_training(spark, sf):
    """ML1-ML8: train ridge / random forest / GBT on the reference slice, score the current slice, rank."""
    t = split_table(spark, sf)
    train, test = t.filter(F.col("split") == "reference"), t.filter(F.col("split") == "current")
    fitted, summary = ML.train_models(train, ML.default_specs())
    ranking = ML.rank_models(ML.stacked_predictions(fitted, test))
    return summary.select("model", "fit_seconds", "status").join(ranking, "model", "left")   # a failed model is a row too


def model_comparison(spark, sf):
    """ML9: compare the trained models on the current slice with MAPE and scoring time; pick the best."""
    t = split_table(spark, sf)
    train, test = t.filter(F.col("split") == "reference"), t.filter(F.col("split") == "current")
    fitted, summary = ML.train_models(train, ML.default_specs())
    return ML.compare_models(fitted, test, fit_summary=summary)


def model_persistence(spark, sf):
    """ML10: save a fitted pipeline, reload it, and compare predictions on the whole training table."""
    t = FE.drop_incomplete(FX.feats(spark, sf))
    fitted, _ = ML.train_models(t, [ML.ModelSpec("Ridge", "ridge")])
    path = scratch_dir(spark, "model") + "/Ridge"
    reloaded = ML.save_and_reload(fitted["Ridge"], path)
    a = fitted["Ridge"].transform(t).select("city", "timestamp", F.col("prediction").alias("p1"))
    b = reloaded.transform(t).select("city", "timestamp", F.col("prediction").alias("p2"))
    return a.join(b, ["city", "timestamp"]).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"))


SQL["model_persistence"] = O.with_views(["feats"], "SELECT count(*) AS rows, 0.0::DOUBLE AS max_abs_diff FROM train", [("train", TRAIN_SQL)])


def forecast_recursive_mllib(spark, sf):
    """TS5 with an MLlib ridge model over the full input, recursed in one aggregate() per entity."""
    hourly = cut_lineage(FX.series(spark, sf))   # one scan of the raw observations for all branches
    train = FE.drop_incomplete(FX.feats(spark, sf, hourly))
    model = ML.fit_state_model(train, FULL_INPUTS)
    b0, w = ML.linear_coefficients(model)   # #features doubles: the model itself, not data
    step = FC.linear_step(F.lit(b0), [F.lit(x) for x in w], FULL_INPUTS, HELD)
    fc = FC.recursive_forecast(full_seeds(spark, sf, hourly), step, extra_cols=["data_source"])
    return FC.label_forecast(fc, "Ridge", "v1")


def forecast_recursive_tree(spark, sf):
    """TS5 with a tree ensemble over the full input: one MLlib transform per step over all entities; lineage cut by checkpoint."""
    hourly = cut_lineage(FX.series(spark, sf))   # one scan of the raw observations for all branches
    train = FE.drop_incomplete(FX.feats(spark, sf, hourly))
    gbt = next(s for s in ML.default_specs() if s.kind == "gbt")
    model = ML.fit_state_model(train, FULL_INPUTS, kind=gbt.kind, params=gbt.params)
    state = full_seeds(spark, sf, hourly).withColumn("preds", F.array().cast("array<double>"))
    for i in range(1, FC.FORECAST_STEPS + 1):
        at = F.col("last_timestamp") + F.make_dt_interval(F.lit(0), F.lit(i * FC.STEP_HOURS))
        x = state.withColumns({f: c.cast("double") for f, c in FC.step_inputs(F.col("state"), at, HELD).items()})
        p = F.least(F.greatest(F.col("prediction"), F.lit(0.0)), F.lit(500.0))
        state = model.transform(x).select(
            "city", "last_timestamp", "data_source", *HELD,
            F.concat(F.slice("state", 4, 21), F.array(p, p, p)).alias("state"),
            F.concat("preds", F.array(p)).alias("preds"))
        state = cut_lineage(state)   # one row per entity; without it each step would evaluate the ones before it again
    fc = state.select("city", "last_timestamp", "data_source", F.posexplode("preds").alias("_pos", "_p"))
    step = (F.col("_pos") + 1).cast("int")
    out = fc.select("city", (F.col("last_timestamp") + F.make_dt_interval(F.lit(0), step * 3)).alias("timestamp"),
                    step.alias("forecast_step"), (step * 3).alias("hours_ahead"),
                    F.bround("_p", 2).alias("predicted_aqi"), "data_source")
    return FC.label_forecast(out, "GradientBoosting", "v1")


QUERIES.update({
    "baseline_backtest": baseline_backtest, "backtest_predictions": backtest_predictions, "minmax_scaled": minmax_scaled, "sequence_regression": sequence_regression,
    "model_training": model_training, "model_comparison": model_comparison, "model_persistence": model_persistence,
    "forecast_recursive_mllib": forecast_recursive_mllib, "forecast_recursive_tree": forecast_recursive_tree,
})
