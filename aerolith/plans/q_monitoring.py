"""Registered queries: splits, drift, performance, status and retraining decision (WN8, WN9, MO1-MO11, AG16-AG18)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.operators import features as FE
from aerolith.operators import model_store as MS
from aerolith.operators import monitoring as M
from aerolith.operators import registry as R
from aerolith.plans import oracle as O
from aerolith.session import cut_lineage
from aerolith.sources import fixtures as FX
from aerolith.sources import manifest as MF

QUERIES, SQL = {}, {}

NUMERIC = ["pm2_5", "pm10", "temperature", "us_aqi", "n_obs", "hour", "day", "month", "year", "is_weekend",
           "aqi_lag_1", "aqi_lag_3", "aqi_lag_6", "aqi_lag_24", "aqi_roll_3", "aqi_roll_6", "aqi_roll_24"]
CATEGORICAL = ["city", "day_of_week", "season"]


def split_table(spark, sf):
    """Training rows (DQ6) split 80/20 by global position in (timestamp, city) order.

    The split table feeds several consumers (PSI, TVD, performance, counts),
    each of which would otherwise recompute the feature pipeline; it is
    materialised with a reliable checkpoint (``spark.checkpoint.dir``), and so are the rows
    before the split, which reads them twice.
    """
    return cut_lineage(M.chronological_split(cut_lineage(FE.drop_incomplete(FX.feats(spark, sf))), ("timestamp", "city"), 0.8))


TRAIN_SQL = """SELECT * FROM feats WHERE aqi_lag_1 IS NOT NULL AND aqi_lag_3 IS NOT NULL AND aqi_lag_6 IS NOT NULL
  AND aqi_lag_24 IS NOT NULL AND aqi_roll_3 IS NOT NULL AND aqi_roll_6 IS NOT NULL
  AND aqi_roll_24 IS NOT NULL AND target_aqi IS NOT NULL AND us_aqi IS NOT NULL"""
SPLIT_SQL = """SELECT *, CASE WHEN row_number() OVER (ORDER BY "timestamp", city) - 1 <
    floor(count(*) OVER () * 0.8)
    THEN 'reference' ELSE 'current' END AS split FROM train"""
SPLIT_VIEWS = [("train", TRAIN_SQL), ("split_t", SPLIT_SQL)]


def _with_split(body: str, extra=()) -> str:
    return O.with_views(["feats"], body, SPLIT_VIEWS + list(extra))


def chrono_split_global(spark, sf):
    return split_table(spark, sf).select("city", "timestamp", "split")


SQL["chrono_split_global"] = _with_split('SELECT city, "timestamp", split FROM split_t')


def chrono_split_entity(spark, sf):
    """WN9: per-entity chronological 80/20 split (row number vs floor(0.8 * entity rows))."""
    t = FE.drop_incomplete(FX.feats(spark, sf))
    w = Window.partitionBy("city").orderBy("timestamp")
    t = t.withColumn("_rn", F.row_number().over(w)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("city")))
    return t.select("city", "timestamp", F.when(F.col("_rn") <= F.floor(F.col("_n") * 0.8), F.lit("train"))
                    .otherwise(F.lit("test")).alias("split"))


SQL["chrono_split_entity"] = O.with_views(["feats"], """
SELECT city, "timestamp", CASE WHEN row_number() OVER (PARTITION BY city ORDER BY "timestamp") <= floor(count(*) OVER (PARTITION BY city) * 0.8)
  THEN 'train' ELSE 'test' END AS split FROM train""", [("train", TRAIN_SQL)])


def psi_report(spark, sf):
    return M.psi_report(split_table(spark, sf), NUMERIC)


def _psi_sql_views():
    casts = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in NUMERIC)
    probs = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"
    return [
        ("long", f"""SELECT split AS side, feature, value FROM (UNPIVOT (SELECT split, {casts} FROM split_t)
            ON {', '.join(NUMERIC)} INTO NAME feature VALUE value) WHERE value IS NOT NULL AND NOT isnan(value)"""),
        ("stats", """SELECT feature, count(*) FILTER (WHERE side = 'reference') AS reference_samples,
            count(*) FILTER (WHERE side = 'current') AS current_samples,
            avg(value) FILTER (WHERE side = 'reference') AS reference_mean, avg(value) FILTER (WHERE side = 'current') AS current_mean,
            min(value) FILTER (WHERE side = 'reference') AS rmin, max(value) FILTER (WHERE side = 'reference') AS rmax,
            min(value) FILTER (WHERE side = 'current') AS cmin, max(value) FILTER (WHERE side = 'current') AS cmax
            FROM long GROUP BY feature"""),
        ("q", f"""SELECT feature, list_sort(list_distinct(quantile_cont(value, {probs}))) AS e FROM long
            WHERE side = 'reference' GROUP BY feature"""),
        ("edges", "SELECT feature, CASE WHEN len(e) >= 2 THEN e[2:len(e) - 1] ELSE []::DOUBLE[] END AS inner_e FROM q"),
        ("counts", """SELECT l.feature, len(list_filter(ed.inner_e, lambda x: x < l.value)) AS bin,
            count(*) FILTER (WHERE side = 'reference') AS r, count(*) FILTER (WHERE side = 'current') AS c
            FROM long l JOIN edges ed USING (feature) GROUP BY ALL"""),
        ("grid", "SELECT feature, unnest(range(0, len(inner_e) + 1)) AS bin FROM edges"),
        ("raw", """SELECT feature, sum((pc - pr) * ln(pc / pr)) AS psi FROM (
            SELECT g.feature, greatest(coalesce(c.r, 0) / greatest(s.reference_samples, 1), 1e-6) AS pr,
                   greatest(coalesce(c.c, 0) / greatest(s.current_samples, 1), 1e-6) AS pc
            FROM grid g LEFT JOIN counts c USING (feature, bin) JOIN stats s USING (feature)) GROUP BY feature"""),
        ("psi_t", """SELECT s.feature, CASE WHEN reference_samples = 0 OR current_samples = 0 THEN NULL
              WHEN rmin = rmax THEN CASE WHEN cmin = cmax AND cmin = rmin THEN 0.0 ELSE 'inf'::DOUBLE END
              ELSE r.psi END AS psi, reference_mean, current_mean, reference_samples, current_samples
            FROM stats s LEFT JOIN raw r USING (feature)"""),
        ("psi_r", """SELECT feature, round(psi, 6) AS psi,
              CASE WHEN psi IS NULL THEN 'UNAVAILABLE' WHEN psi = 'inf'::DOUBLE THEN 'DRIFT' WHEN psi < 0.10 THEN 'NO_DRIFT'
                   WHEN psi < 0.25 THEN 'MODERATE_DRIFT' ELSE 'DRIFT' END AS status,
              round(reference_mean, 6) AS reference_mean, round(current_mean, 6) AS current_mean,
              reference_samples, current_samples FROM psi_t"""),
    ]


SQL["psi_report"] = _with_split("SELECT * FROM psi_r ORDER BY psi DESC NULLS LAST, feature", _psi_sql_views())


def tvd_report(spark, sf):
    return M.tvd_report(split_table(spark, sf), CATEGORICAL)


def _tvd_sql_views():
    casts = ", ".join(f"CAST({f} AS VARCHAR) AS {f}" for f in CATEGORICAL)
    return [
        ("clong", f"""SELECT split AS side, feature, category FROM (UNPIVOT (SELECT split, {casts} FROM split_t)
            ON {', '.join(CATEGORICAL)} INTO NAME feature VALUE category) WHERE category IS NOT NULL"""),
        ("ref_d", """SELECT feature, category, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p
            FROM clong WHERE side = 'reference' GROUP BY feature, category"""),
        ("cur_d", """SELECT feature, category, count(*) / sum(count(*)) OVER (PARTITION BY feature) AS p
            FROM clong WHERE side = 'current' GROUP BY feature, category"""),
        ("tvd_raw", """SELECT coalesce(r.feature, c.feature) AS feature, sum(abs(coalesce(r.p, 0) - coalesce(c.p, 0))) / 2.0 AS value
            FROM ref_d r FULL OUTER JOIN cur_d c ON r.feature = c.feature AND r.category = c.category GROUP BY 1"""),
        ("tvd_t", """SELECT f.feature, 'Total Variation Distance' AS metric,
              CASE WHEN f.rs = 0 OR f.cs = 0 THEN NULL ELSE round(t.value, 6) END AS value,
              f.ru AS reference_unique_values, f.cu AS current_unique_values, f.rs AS reference_samples, f.cs AS current_samples
            FROM (SELECT feature, count(*) FILTER (WHERE side = 'reference') AS rs, count(*) FILTER (WHERE side = 'current') AS cs,
                    count(DISTINCT category) FILTER (WHERE side = 'reference') AS ru,
                    count(DISTINCT category) FILTER (WHERE side = 'current') AS cu FROM clong GROUP BY feature) f
            LEFT JOIN tvd_raw t USING (feature)"""),
        ("tvd_r", """SELECT feature, metric, value, CASE WHEN value IS NULL THEN 'UNAVAILABLE' WHEN value < 0.10 THEN 'NO_DRIFT'
              WHEN value < 0.25 THEN 'MODERATE_DRIFT' ELSE 'DRIFT' END AS status, reference_unique_values,
              current_unique_values, reference_samples, current_samples FROM tvd_t"""),
    ]


SQL["tvd_report"] = _with_split("SELECT * FROM tvd_r", _tvd_sql_views())


def drift_summary(spark, sf):
    return M.drift_summary(psi_report(spark, sf))


DRIFT_SUMMARY_SQL = """SELECT count(*) AS numeric_features, count(*) FILTER (WHERE status = 'DRIFT') AS drift_features,
  count(*) FILTER (WHERE status = 'MODERATE_DRIFT') AS moderate_drift_features,
  count(*) FILTER (WHERE status = 'NO_DRIFT') AS no_drift_features,
  count(*) FILTER (WHERE status = 'UNAVAILABLE') AS unavailable_features,
  round_even(count(*) FILTER (WHERE status = 'DRIFT') / count(*) * 100, 2) AS drift_percentage,
  round_even(count(*) FILTER (WHERE status = 'MODERATE_DRIFT') / count(*) * 100, 2) AS moderate_drift_percentage,
  round(avg(psi) FILTER (WHERE psi IS NOT NULL AND NOT isinf(psi)), 6) AS mean_psi FROM psi_r"""
SQL["drift_summary"] = _with_split(DRIFT_SUMMARY_SQL, _psi_sql_views())


#: the registered model of these queries: one-feature least squares, a version per feature
MODEL, VERSION_FEATURES = "LinearState", ("us_aqi", "aqi_roll_3")


def build_registry(spark, path, reference):
    """Register a version of MODEL for each feature, fitted and measured on the ``reference`` rows; versions that are there stay."""
    there = len(MF.snapshot(spark, path).tagged(model=MODEL))
    if there >= len(VERSION_FEATURES):
        return path
    reference = reference.select("timestamp", "city", *VERSION_FEATURES, "target_aqi")
    digest = MS.data_digest(reference)
    version = R.dataset_version(reference).first()[0]
    for feature in VERSION_FEATURES[there:]:
        stages = [VectorAssembler(inputCols=[feature], outputCol="features"), LinearRegression(labelCol="target_aqi", solver="normal")]
        model = MS.fit_once(Pipeline(stages=stages), reference, {"kind": "least squares", "features": [feature]}, digest=digest).model
        row = M.regression_metrics(model.transform(reference), "target_aqi", "prediction").first()
        MS.register(spark, path, MODEL, model, {"MAE": row["mae"], "RMSE": row["rmse"], "R2": row["r2"] or 0.0}, version)
    return path


def _shared_registry(spark, t):
    """A registry of the reference rows of ``t``, built once for the same rows."""
    reference = t.filter(F.col("split") == "reference")
    digest = MS.data_digest(reference.select("timestamp", "city", *VERSION_FEATURES, "target_aqi"))
    return build_registry(spark, f"{MS.default_store(spark)}-registry/{digest[:24]}", reference)


def performance(t, prod):
    """MO7: the version in production scores the current rows; its error against the threshold and against its registry row."""
    scored = MS.score(prod, t.filter(F.col("split") == "current"))
    return M.performance_status(M.regression_metrics(scored, "target_aqi", "y_hat"), F.lit(prod.row["metrics"]["RMSE"]))


def monitor_row(t, prod):
    """MO7/MO8/MO10: full drift analysis of ``t`` (numeric and categorical reports with their summaries), performance of the
    version in production, overall status: one row."""
    num = M.drift_summary(M.psi_report(t, NUMERIC))
    cat = M.categorical_summary(M.tvd_report(t, CATEGORICAL))
    perf = performance(t, prod)
    # three one-row summaries, combined as scalar subqueries (one per summary, no join needed)
    num_row = num.select(F.struct("*")).scalar()
    row = perf.select(
        F.lit(prod.row["model"]).alias("model"), F.lit(prod.row["version"]).alias("model_version"),
        "samples", "mae", "rmse", "r2", "registered_rmse",
        F.round("rmse_change", 6).alias("rmse_change"), F.round("rmse_change_percentage", 6).alias("rmse_change_percentage"),
        "threshold", "performance_status",
        F.struct(*[num_row[c].alias(c) for c in
                   ("numeric_features", "drift_features", "moderate_drift_features", "drift_percentage", "mean_psi")]
                 ).alias("_num"),
        cat.select(F.struct("*")).scalar().alias("_cat"),
    )
    row = row.select("*", "_num.*", F.col("_cat.features_checked"), F.col("_cat.categorical_drift_features"),
                     F.col("_cat.categorical_moderate_drift_features")).drop("_num", "_cat")
    return row.withColumn("overall_status", M.overall_status())


def monitor_status(spark, sf):
    """MO7-MO11: one monitoring row for the model in production."""
    t = split_table(spark, sf)
    return monitor_row(t, MS.production(spark, _shared_registry(spark, t), MODEL))


def _version_sql(number, feature):
    err = f"(alpha + beta * {feature} - target_aqi)"
    coef = f"""SELECT coalesce(regr_intercept(target_aqi, {feature}), avg(target_aqi)) AS alpha, coalesce(regr_slope(target_aqi, {feature}), 0.0) AS beta
        FROM split_t WHERE split = 'reference'"""
    return f"""SELECT {number} AS version_no, split, count(*) AS samples, round(avg(abs({err})), 4) AS mae, round(sqrt(avg({err} ^ 2)), 4) AS rmse,
      round(1 - sum({err} ^ 2) / (sum(target_aqi * target_aqi) - sum(target_aqi) ^ 2 / count(*)), 4) AS r2 FROM split_t, ({coef}) GROUP BY split"""


def _mon_sql(version_no):
    """The monitoring row with a version of the model in production."""
    return f"""SELECT '{MODEL}' AS model, 'v' || c.version_no AS model_version, c.samples, c.mae, c.rmse, c.r2, r.rmse AS registered_rmse,
      round(CASE WHEN r.rmse > 0 THEN c.rmse - r.rmse END, 6) AS rmse_change,
      round(CASE WHEN r.rmse > 0 THEN (c.rmse - r.rmse) / r.rmse * 100 END, 6) AS rmse_change_percentage,
      30.0::DOUBLE AS threshold, CASE WHEN c.rmse >= 30.0 THEN 'ALERT' ELSE 'NORMAL' END AS performance_status,
      n.numeric_features, n.drift_features, n.moderate_drift_features, n.drift_percentage, n.mean_psi,
      k.features_checked, k.categorical_drift_features, k.categorical_moderate_drift_features
      FROM per_version c JOIN per_version r ON r.version_no = c.version_no AND r.split = 'reference', num_s n, cat_s k
      WHERE c.split = 'current' AND c.version_no = {version_no}"""


_OVERALL_SQL = """CASE WHEN performance_status = 'ALERT' THEN 'ALERT'
      WHEN drift_features > 0 OR categorical_drift_features > 0 THEN 'DRIFT_DETECTED'
      WHEN moderate_drift_features > 0 OR categorical_moderate_drift_features > 0 THEN 'MODERATE_DRIFT'
      WHEN mean_psi IS NOT NULL AND mean_psi >= 0.15 THEN 'MODERATE_DRIFT' ELSE 'HEALTHY' END AS overall_status"""
MONITOR_VIEWS = _psi_sql_views() + _tvd_sql_views() + [
    ("num_s", DRIFT_SUMMARY_SQL),
    ("cat_s", """SELECT count(*) AS features_checked, count(*) FILTER (WHERE status = 'DRIFT') AS categorical_drift_features,
      count(*) FILTER (WHERE status = 'MODERATE_DRIFT') AS categorical_moderate_drift_features FROM tvd_r"""),
    ("per_version", " UNION ALL ".join(_version_sql(i, f) for i, f in enumerate(VERSION_FEATURES, 1))),
    # promoted only when strictly better than the version in production
    ("prod", "SELECT CASE WHEN max(rmse) FILTER (WHERE version_no = 2) < max(rmse) FILTER (WHERE version_no = 1) THEN 2 ELSE 1 END AS version_no FROM per_version WHERE split = 'reference'"),
    ("mon", _mon_sql("(SELECT version_no FROM prod)")),
    ("mon_s", f"SELECT *, {_OVERALL_SQL} FROM mon"),
]
SQL["monitor_status"] = _with_split("SELECT * FROM mon_s", MONITOR_VIEWS)


def retrain_decision(spark, sf):
    d = M.retrain_decision(monitor_status(spark, sf))
    return d.select("overall_status", "rmse", "drift_percentage", "rmse_change_percentage", "drift_detected",
                    "significant_drift", "performance_threshold_exceeded", "rmse_meaningfully_degraded",
                    "drift_with_degradation", "seasonal_or_covariate_drift_only", "retraining_required",
                    "reasons", "observations")


SQL["retrain_decision"] = _with_split("""
WITH d0 AS (SELECT *, overall_status IN ('DRIFT_DETECTED', 'MODERATE_DRIFT') AS drift_detected,
    drift_percentage >= 30.0 AS significant_drift,
    coalesce(rmse IS NOT NULL AND rmse >= threshold, false) AS performance_threshold_exceeded,
    coalesce(rmse IS NOT NULL AND rmse_change_percentage >= 10.0, false) AS rmse_meaningfully_degraded FROM mon_s),
d1 AS (SELECT *, significant_drift AND rmse_meaningfully_degraded AS drift_with_degradation,
    significant_drift AND NOT rmse_meaningfully_degraded AND NOT performance_threshold_exceeded AS seasonal_or_covariate_drift_only FROM d0)
SELECT overall_status, rmse, drift_percentage, rmse_change_percentage, drift_detected, significant_drift,
  performance_threshold_exceeded, rmse_meaningfully_degraded, drift_with_degradation, seasonal_or_covariate_drift_only,
  performance_threshold_exceeded OR drift_with_degradation AS retraining_required,
  list_filter([CASE WHEN performance_threshold_exceeded THEN printf('Current production RMSE exceeded the configured alert threshold: %.4f >= %.4f.', rmse, threshold) END,
    CASE WHEN drift_with_degradation THEN 'Significant feature drift is accompanied by meaningful model-performance degradation.' END], lambda x: x IS NOT NULL) AS reasons,
  list_filter([CASE WHEN significant_drift THEN printf('Significant feature drift detected: %.2f%% of monitored numeric features.', drift_percentage) END,
    CASE WHEN rmse_meaningfully_degraded THEN printf('Current RMSE increased by %.2f%% relative to the registered production baseline.', rmse_change_percentage) END,
    CASE WHEN seasonal_or_covariate_drift_only THEN 'Drift is currently not accompanied by meaningful RMSE degradation. Continue monitoring without retraining.' END],
    lambda x: x IS NOT NULL) AS observations
FROM d1""", MONITOR_VIEWS)


def regression_metrics(spark, sf):
    """AG16: persistence-forecast metrics over the whole training table."""
    return M.regression_metrics(FE.drop_incomplete(FX.feats(spark, sf)), "target_aqi", "us_aqi")


SQL["regression_metrics"] = O.with_views(["feats"], """
SELECT count(*) AS samples, round(avg(abs(us_aqi - target_aqi)), 4) AS mae, round(sqrt(avg((us_aqi - target_aqi) ^ 2)), 4) AS rmse,
  round(1 - sum((us_aqi - target_aqi) ^ 2) / (sum(target_aqi * target_aqi) - sum(target_aqi) ^ 2 / count(*)), 4) AS r2 FROM train""",
    [("train", TRAIN_SQL)])


def metrics_grouping_sets(spark, sf):
    """AG18: per-entity metric rows plus the pooled 'Overall' row via GROUPING SETS."""
    t = FE.drop_incomplete(FX.feats(spark, sf))
    return t.sparkSession.sql("""
        SELECT coalesce(city, 'Overall') AS city, count(*) AS samples,
          round(avg(abs(us_aqi - target_aqi)), 4) AS mae, round(sqrt(avg(pow(us_aqi - target_aqi, 2))), 4) AS rmse,
          round(1 - try_divide(sum(pow(us_aqi - target_aqi, 2)), var_pop(target_aqi) * count(*)), 4) AS r2,
          round(avg(CASE WHEN target_aqi <> 0 THEN abs((target_aqi - us_aqi) / target_aqi) * 100 END), 4) AS mape
        FROM {t} GROUP BY GROUPING SETS ((city), ())""", t=t)


SQL["metrics_grouping_sets"] = O.with_views(["feats"], """
SELECT coalesce(city, 'Overall') AS city, count(*) AS samples, round(avg(abs(us_aqi - target_aqi)), 4) AS mae,
  round(sqrt(avg((us_aqi - target_aqi) ^ 2)), 4) AS rmse,
  round(1 - sum((us_aqi - target_aqi) ^ 2) / (sum(target_aqi * target_aqi) - sum(target_aqi) ^ 2 / count(*)), 4) AS r2,
  round(avg(CASE WHEN target_aqi <> 0 THEN abs((target_aqi - us_aqi) / target_aqi) * 100 END), 4) AS mape
FROM train GROUP BY GROUPING SETS ((city), ())""", [("train", TRAIN_SQL)])

QUERIES.update({
    "chrono_split_global": chrono_split_global, "chrono_split_entity": chrono_split_entity,
    "psi_report": psi_report, "tvd_report": tvd_report, "drift_summary": drift_summary,
    "monitor_status": monitor_status, "retrain_decision": retrain_decision,
    "regression_metrics": regression_metrics, "metrics_grouping_sets": metrics_grouping_sets,
})
