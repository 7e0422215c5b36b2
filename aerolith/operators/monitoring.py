"""Drift and performance monitoring (WN8, MO1-MO9, SC14, SC16, JN6, JN7, AG16).

PSI covers *all* numeric features at once: the two slices are unpivoted to
``(side, feature, value)``; reference quantile edges come from the exact
quantile operator (one small row per feature, so the edges table is bounded by
the number of features and broadcast); every value is binned with
``size(filter(inner_edges, e -> e < value))`` (right-closed bins, outer edges
+/-inf), and one hash aggregate per (feature, bin) gives counts, means and
ranges. Nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.numeric import clean_double, percent_change, relative_change
from aerolith.operators.ranking import quantiles, with_global_position

# ---------------------------------------------------------------------------
# Fixed values (thresholds of the reference monitoring).
# ---------------------------------------------------------------------------
PSI_NO_DRIFT = 0.10
PSI_MODERATE_DRIFT = 0.25
CATEGORICAL_NO_DRIFT = 0.10
CATEGORICAL_MODERATE_DRIFT = 0.25
EPSILON = 1e-6
PSI_BINS = 10
CONFIGURED_DRIFT_THRESHOLD = 0.15
RMSE_ALERT_THRESHOLD = 30.0
DRIFT_PERCENTAGE_THRESHOLD = 30.0
RMSE_DEGRADATION_PERCENT_THRESHOLD = 10.0
EXCLUDED_COLUMNS = ["timestamp", "target_aqi"]
TVD_METRIC = "Total Variation Distance"
# ---------------------------------------------------------------------------

REFERENCE, CURRENT = "reference", "current"
#: distinct times over which one task may keep a running sum
MOST_TIMES = 1_000_000


def chronological_split(df: DataFrame, order=("timestamp", "city"), fraction: float = 0.8,
                        col: str = "split") -> DataFrame:
    """WN8: first ``int(n * fraction)`` rows of the total order -> reference, rest -> current.

    Positions without a global sort: rows are counted per time value (one
    row per distinct time -- bounded by span / grain on bucketed tables),
    running offsets are taken over that small table, and rows are numbered
    inside each time value by the remaining order columns (bounded by the
    number of entities). Deterministic, so no materialisation is needed.
    Times that are not bucketed go through ``ranking.with_global_position``, which ranges over the
    whole order: so do more than ``MOST_TIMES`` distinct ones.
    """
    ts, rest = order[0], list(order[1:])
    per_ts = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_n_ts"))
    if per_ts.limit(MOST_TIMES + 1).count() > MOST_TIMES:
        placed = with_global_position(df, list(order), pos_col="_split_pos")
        n = df.agg(F.count(F.lit(1))).scalar()
        return placed.withColumn("_n", n).withColumn(col, F.when(F.col("_split_pos") < F.floor(F.col("_n") * F.lit(float(fraction))), F.lit(REFERENCE))
                                                     .otherwise(F.lit(CURRENT))).drop("_split_pos", "_n")
    cut = F.floor(F.col("_n") * F.lit(float(fraction)))
    # one row per distinct time value: the only single-partition step, bounded by span / grain
    offsets = per_ts.select(ts, F.coalesce(F.sum("_n_ts").over(
        Window.orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n_ts").over(Window.orderBy(ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"))
    within = F.row_number().over(Window.partitionBy(ts).orderBy(*rest)) - 1
    pos = df.join(offsets, ts).withColumn("_split_pos", F.col("_off") + within)
    return pos.withColumn(col, F.when(F.col("_split_pos") < cut, F.lit(REFERENCE)).otherwise(F.lit(CURRENT))) \
        .drop("_split_pos", "_off", "_n")


def classify_psi(psi: Column) -> Column:
    """SC14: PSI band; NULL -> UNAVAILABLE, +inf -> DRIFT."""
    return (F.when(psi.isNull() | F.isnan(psi), F.lit("UNAVAILABLE"))
            .when(psi == F.lit(float("inf")), F.lit("DRIFT"))
            .when(psi < F.lit(PSI_NO_DRIFT), F.lit("NO_DRIFT"))
            .when(psi < F.lit(PSI_MODERATE_DRIFT), F.lit("MODERATE_DRIFT"))
            .otherwise(F.lit("DRIFT")))


def classify_distance(d: Column) -> Column:
    """SC14: categorical distance band."""
    return (F.when(d.isNull() | F.isnan(d), F.lit("UNAVAILABLE"))
            .when(d < F.lit(CATEGORICAL_NO_DRIFT), F.lit("NO_DRIFT"))
            .when(d < F.lit(CATEGORICAL_MODERATE_DRIFT), F.lit("MODERATE_DRIFT"))
            .otherwise(F.lit("DRIFT")))


def _all_features(report: DataFrame, features: list[str]) -> DataFrame:
    """``report`` with a row for every feature: one without any value has none of its own. A row per feature, bounded by the schema."""
    names = report.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    return names.join(report, "feature", "left")


def _long(df: DataFrame, features: list[str], side_col: str) -> DataFrame:
    wide = df.select(F.col(side_col).alias("side"), *[clean_double(f).alias(f) for f in features])
    return wide.unpivot(["side"], features, "feature", "value").filter(F.col("value").isNotNull())


def psi_report(df: DataFrame, features: list[str], side_col: str = "split", bins: int = PSI_BINS,
               digits: int | None = 6, accuracy: int | None = None) -> DataFrame:
    """MO1/MO2: PSI, status, means and sample counts for every feature; sorted PSI desc, NULLs last.

    Bin edges are exact reference quantiles (linear interpolation) unless
    ``accuracy`` is given, which switches them to the mergeable approximate
    sketch (rank error <= n / accuracy) for very large reference slices.
    """
    long = _long(df, features, side_col)
    probs = [i / bins for i in range(bins + 1)]
    q = quantiles(long.filter(F.col("side") == REFERENCE), ["feature"], "value", probs, accuracy, bounded_groups=True)
    edges = q.selectExpr("feature", "array_distinct(array_sort(quantiles)) AS _e").selectExpr(
        "feature", "slice(_e, 2, greatest(size(_e) - 2, 0)) AS inner")
    # one row per feature: bounded by the schema, safe to broadcast
    binned = long.join(F.broadcast(edges), "feature", "left").withColumn(
        "bin", F.expr("coalesce(size(filter(inner, e -> e < value)), 0)"))
    side = lambda f, s, name: F.expr(f"{f}(IF(side = '{s}', value, NULL)) AS {name}")
    cells = binned.groupBy("feature", "bin").agg(*[
        side(f, s, f"{f}_{k}") for k, s in (("r", REFERENCE), ("c", CURRENT)) for f in ("count", "sum", "min", "max")])
    # a bin empty on both sides adds nothing to the index, so only the bins found are listed (at most ``bins`` per feature)
    per = cells.groupBy("feature").agg(
        F.sum("count_r").alias("reference_samples"), F.sum("count_c").alias("current_samples"),
        F.sum("sum_r").alias("_sr"), F.sum("sum_c").alias("_sc"), F.min("min_r").alias("_rmin"), F.max("max_r").alias("_rmax"),
        F.min("min_c").alias("_cmin"), F.max("max_c").alias("_cmax"),
        F.array_sort(F.collect_list(F.struct("bin", "count_r", "count_c"))).alias("_cells"))
    share = lambda n, total: f"greatest(x.{n} / greatest({total}, 1), {EPSILON}D)"
    pr, pc = share("count_r", "reference_samples"), share("count_c", "current_samples")
    index = f"aggregate(_cells, 0D, (a, x) -> a + ({pc} - {pr}) * ln({pc} / {pr}))"
    out = per.selectExpr(
        "feature", "reference_samples", "current_samples", "try_divide(_sr, reference_samples) AS reference_mean",
        "try_divide(_sc, current_samples) AS current_mean",
        f"""CASE WHEN reference_samples = 0 OR current_samples = 0 THEN NULL
            WHEN _rmin = _rmax THEN IF(_cmin = _cmax AND _cmin = _rmin, 0D, double('Infinity'))
            ELSE {index} END AS psi""")
    out = _all_features(out, features).fillna(0, ["reference_samples", "current_samples"]).withColumn("status", classify_psi(F.col("psi")))
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("psi", "reference_mean", "current_mean")})
    return out.select("feature", "psi", "status", "reference_mean", "current_mean",
                      "reference_samples", "current_samples").orderBy(F.col("psi").desc_nulls_last(), "feature")


def tvd_report(df: DataFrame, features: list[str], side_col: str = "split", digits: int | None = 6) -> DataFrame:
    """MO3/MO4/JN6: total variation distance of categorical distributions, missing categories = 0."""
    wide = df.select(F.col(side_col).alias("side"), *[F.col(f).cast("string").alias(f) for f in features])
    long = wide.unpivot(["side"], features, "feature", "category").filter(F.col("category").isNotNull())
    is_ref, is_cur = F.col("side") == REFERENCE, F.col("side") == CURRENT
    # conditional counts per category give the full outer alignment of both sides in one aggregation
    per_cat = long.groupBy("feature", "category").agg(F.count_if(is_ref).alias("r"), F.count_if(is_cur).alias("c"))
    totals = per_cat.groupBy("feature").agg(
        F.sum("r").alias("reference_samples"), F.sum("c").alias("current_samples"),
        F.count_if(F.col("r") > 0).alias("reference_unique_values"),
        F.count_if(F.col("c") > 0).alias("current_unique_values"))
    # one row per feature: bounded by the schema, broadcast back to the category rows
    cells = per_cat.join(F.broadcast(totals), "feature")
    diff = F.abs(F.try_divide("r", "reference_samples") - F.try_divide("c", "current_samples"))  # NULL where a slice is empty
    per_feat = cells.groupBy("feature", "reference_samples", "current_samples", "reference_unique_values",
                             "current_unique_values").agg((F.sum(diff) / F.lit(2.0)).alias("_tvd"))
    value = F.when((F.col("reference_samples") == 0) | (F.col("current_samples") == 0),
                   F.lit(None).cast("double")).otherwise(F.col("_tvd"))
    out = _all_features(per_feat.withColumn("value", value), features).fillna(0, [
        "reference_samples", "current_samples", "reference_unique_values", "current_unique_values"])
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out.select("feature", F.lit(TVD_METRIC).alias("metric"), "value",
                      classify_distance(F.col("value")).alias("status"),
                      F.col("reference_unique_values").cast("bigint").alias("reference_unique_values"),
                      F.col("current_unique_values").cast("bigint").alias("current_unique_values"),
                      F.col("reference_samples").cast("bigint").alias("reference_samples"),
                      F.col("current_samples").cast("bigint").alias("current_samples"))


def drift_summary(psi: DataFrame) -> DataFrame:
    """MO5/MO6: counts by status, percentages (2 dp) and mean PSI over finite values."""
    finite = F.col("psi").isNotNull() & (F.abs(F.col("psi")) != F.lit(float("inf")))
    total = F.count(F.lit(1))
    # a report of no features has no percentages
    percentage = lambda status: F.bround(F.try_divide(F.count_if(F.col("status") == status), total) * 100, 2)
    return psi.agg(
        total.alias("numeric_features"),
        F.count_if(F.col("status") == "DRIFT").alias("drift_features"),
        F.count_if(F.col("status") == "MODERATE_DRIFT").alias("moderate_drift_features"),
        F.count_if(F.col("status") == "NO_DRIFT").alias("no_drift_features"),
        F.count_if(F.col("status") == "UNAVAILABLE").alias("unavailable_features"),
        percentage("DRIFT").alias("drift_percentage"), percentage("MODERATE_DRIFT").alias("moderate_drift_percentage"),
        F.round(F.avg(F.when(finite, F.col("psi"))), 6).alias("mean_psi"),
    )


def categorical_summary(tvd: DataFrame) -> DataFrame:
    return tvd.agg(
        F.count(F.lit(1)).alias("features_checked"),
        F.count_if(F.col("status") == "DRIFT").alias("categorical_drift_features"),
        F.count_if(F.col("status") == "MODERATE_DRIFT").alias("categorical_moderate_drift_features"),
        F.count_if(F.col("status") == "NO_DRIFT").alias("categorical_no_drift_features"),
    )


def regression_metrics(df: DataFrame, y: str, yhat: str, groups: list[str] | None = None,
                       digits: int | None = 4, extra: dict[str, Column] | None = None) -> DataFrame:
    """AG16: MAE, RMSE, R^2 (and sample count) as plain aggregates, optionally per group, with ``extra`` aggregates beside them.

    R^2 = 1 - SSE/SST with SST from the group's own mean, n times the population variance
    (merged per task without cancellation). A constant target has no R^2 (NULL).
    """
    e = F.col(yhat).cast("double") - F.col(y).cast("double")
    yy = F.col(y).cast("double")
    base = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    g = base.groupBy(*groups) if groups else base.groupBy()
    n = F.count(F.lit(1))
    sst = F.var_pop(yy) * n
    out = g.agg(n.alias("samples"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
                (F.lit(1.0) - F.try_divide(F.sum(e * e), sst)).alias("r2"), *[c.alias(k) for k, c in (extra or {}).items()])
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("mae", "rmse", "r2")})
    return out


def mape(df: DataFrame, y: str, yhat: str) -> Column:
    """AG17: mean absolute percentage error over non-zero actuals (NULL if none)."""
    return F.avg(F.when(F.col(y) != 0, F.abs((F.col(y) - F.col(yhat)) / F.col(y)) * 100))


def performance_status(perf: DataFrame, registered_rmse: Column, threshold: float = RMSE_ALERT_THRESHOLD) -> DataFrame:
    """MO7: current RMSE vs threshold and vs the registered RMSE (SC16)."""
    return perf.withColumns({
        "registered_rmse": registered_rmse,
        "rmse_change": relative_change(F.col("rmse"), registered_rmse),
        "rmse_change_percentage": percent_change(F.col("rmse"), registered_rmse),
        "threshold": F.lit(float(threshold)),
        "performance_status": F.when(F.col("rmse") >= F.lit(float(threshold)), F.lit("ALERT")).otherwise(F.lit("NORMAL")),
    })


def overall_status() -> Column:
    """MO8: ALERT > DRIFT_DETECTED > MODERATE_DRIFT (incl. mean PSI >= 0.15) > HEALTHY."""
    return (F.when(F.col("performance_status") == "ALERT", F.lit("ALERT"))
            .when((F.col("drift_features") > 0) | (F.col("categorical_drift_features") > 0), F.lit("DRIFT_DETECTED"))
            .when((F.col("moderate_drift_features") > 0) | (F.col("categorical_moderate_drift_features") > 0),
                  F.lit("MODERATE_DRIFT"))
            .when(F.col("mean_psi").isNotNull() & (F.col("mean_psi") >= F.lit(CONFIGURED_DRIFT_THRESHOLD)),
                  F.lit("MODERATE_DRIFT"))
            .otherwise(F.lit("HEALTHY")))


def retrain_decision(status: DataFrame) -> DataFrame:
    """MO9: retrain when RMSE >= threshold, or significant drift together with >= 10 % RMSE degradation."""
    available = F.col("rmse").isNotNull()
    sig = F.col("drift_percentage") >= F.lit(DRIFT_PERCENTAGE_THRESHOLD)
    exceeded = F.coalesce(available & (F.col("rmse") >= F.col("threshold")), F.lit(False))
    degraded = F.coalesce(available & (F.col("rmse_change_percentage") >= F.lit(RMSE_DEGRADATION_PERCENT_THRESHOLD)),
                          F.lit(False))
    out = status.withColumns({
        "drift_detected": F.col("overall_status").isin("DRIFT_DETECTED", "MODERATE_DRIFT"),
        "significant_drift": sig,
        "performance_threshold_exceeded": exceeded,
        "rmse_meaningfully_degraded": degraded,
    })
    out = out.withColumns({
        "drift_with_degradation": F.col("significant_drift") & F.col("rmse_meaningfully_degraded"),
        "seasonal_or_covariate_drift_only": F.col("significant_drift") & ~F.col("rmse_meaningfully_degraded")
        & ~F.col("performance_threshold_exceeded"),
    })
    # Decision texts.
    reasons = F.array_compact(F.array(
        F.when(F.col("performance_threshold_exceeded"), F.format_string(
            "Current production RMSE exceeded the configured alert threshold: %.4f >= %.4f.",
            F.col("rmse"), F.col("threshold"))),
        F.when(F.col("drift_with_degradation"), F.lit(
            "Significant feature drift is accompanied by meaningful model-performance degradation.")),
    ))
    observations = F.array_compact(F.array(
        F.when(F.col("significant_drift"), F.format_string(
            "Significant feature drift detected: %.2f%% of monitored numeric features.", F.col("drift_percentage"))),
        F.when(F.col("rmse_meaningfully_degraded"), F.format_string(
            "Current RMSE increased by %.2f%% relative to the registered production baseline.",
            F.col("rmse_change_percentage"))),
        F.when(F.col("seasonal_or_covariate_drift_only"), F.lit(
            "Drift is currently not accompanied by meaningful RMSE degradation. "
            "Continue monitoring without retraining.")),
    ))
    return out.withColumns({
        "retraining_required": F.col("performance_threshold_exceeded") | F.col("drift_with_degradation"),
        "reasons": reasons, "observations": observations,
    })
