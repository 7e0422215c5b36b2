"""Registered queries: model registry (RG1-RG5, WN11, SC15, AG19, SO8, ML8/WN7 ranking over runs)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.operators import registry as R
from aerolith.plans import oracle as O
from aerolith.sources import fixtures as FX

QUERIES, SQL = {}, {}

STATUS_SQL = """SELECT *, CASE WHEN version_no = prod THEN 'production' WHEN promoted THEN 'archived' ELSE 'candidate' END AS status
FROM (SELECT h.*, p.prod FROM hist h LEFT JOIN (SELECT model, max(version_no) AS prod FROM hist WHERE promoted GROUP BY model) p USING (model))"""
HIST_SQL = """SELECT *, previous_best_rmse IS NULL OR rmse < previous_best_rmse AS promoted FROM (
  SELECT *, min(rmse) OVER (PARTITION BY model ORDER BY version_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_best_rmse
  FROM runs)"""


def champion_history(spark, sf):
    return R.champion_history(FX.runs(spark, sf))


SQL["champion_history"] = O.with_views(["runs"], "SELECT * FROM hist", [("hist", HIST_SQL)])


def registry_listing(spark, sf):
    """RG5: every registered version with its derived status."""
    return R.registry_status(R.champion_history(FX.runs(spark, sf)))


SQL["registry_listing"] = O.with_views(["runs"], "SELECT * EXCLUDE (prod) FROM st",
                                       [("hist", HIST_SQL), ("st", STATUS_SQL)])


def production_version(spark, sf):
    st = R.registry_status(R.champion_history(FX.runs(spark, sf)))
    return R.production_versions(st).select("model", "version_no", "run_id", "rmse")


SQL["production_version"] = O.with_views(["runs"], """
SELECT model, version_no, run_id, rmse FROM st WHERE status = 'production'""", [("hist", HIST_SQL), ("st", STATUS_SQL)])


def serving_model(spark, sf):
    """RG3: one model for serving = the production version registered first (lowest run id)."""
    st = R.registry_status(R.champion_history(FX.runs(spark, sf)))
    return R.resolve_production(st, order_col="run_id").select("model", "version_no", "run_id", "rmse")


SQL["serving_model"] = O.with_views(["runs"], """
SELECT model, version_no, run_id, rmse FROM st WHERE status = 'production' ORDER BY run_id LIMIT 1""",
                                    [("hist", HIST_SQL), ("st", STATUS_SQL)])


def rollback(spark, sf):
    """RG4: roll every model back to its version 1; statuses re-derived."""
    runs = FX.runs(spark, sf)
    target = runs.filter(F.col("version_no") == 1).select("model", "version_no")
    st = R.registry_status(R.champion_history(runs), rollback=target)
    return st.select("model", "version_no", "status")


SQL["rollback"] = O.with_views(["runs"], """
SELECT model, version_no, CASE WHEN version_no = 1 THEN 'production' WHEN promoted THEN 'archived' ELSE 'candidate' END AS status
FROM hist""", [("hist", HIST_SQL)])


def rollback_then_promote(spark, sf):
    """RG2/RG4: back to version 1 after version 5 of every model; later versions compete with it."""
    runs = FX.runs(spark, sf)
    back = runs.filter(F.col("version_no") == 1).select("model", "version_no", F.lit(5).alias("after"))
    return R.registry_status(runs, rollback=back).select("model", "version_no", "status")


SQL["rollback_then_promote"] = O.with_views(["runs"], """
SELECT r.model, r.version_no, CASE WHEN r.version_no = p.prod THEN 'production'
  WHEN r.version_no IN (SELECT target FROM step s WHERE s.model = r.model AND s.won) THEN 'archived' ELSE 'candidate' END AS status
FROM runs r JOIN (SELECT model, arg_max(prod, i) AS prod FROM step GROUP BY model) p ON p.model = r.model""", [
    ("ev", """SELECT model, version_no AS seq, 0 AS kind, version_no AS target, rmse FROM runs
      UNION ALL SELECT model, 5, 1, 1, rmse FROM runs WHERE version_no = 1"""),
    ("n", "SELECT *, row_number() OVER (PARTITION BY model ORDER BY seq, kind) AS i FROM ev"),
    ("step", """SELECT model, i, target, target AS prod, rmse AS best, true AS won FROM n WHERE i = 1
      UNION ALL SELECT n.model, n.i, n.target, CASE WHEN n.kind = 1 OR n.rmse < s.best THEN n.target ELSE s.prod END,
        CASE WHEN n.kind = 1 OR n.rmse < s.best THEN n.rmse ELSE s.best END, n.kind = 1 OR n.rmse < s.best
      FROM step s JOIN n ON n.model = s.model AND n.i = s.i + 1""")], recursive=True)


def next_version(spark, sf):
    """SC15: registry version strings (some malformed) -> next version per model."""
    runs = FX.runs(spark, sf)
    ver = F.when(F.col("run_id") % 37 == 0, F.lit("version-x")).when(F.col("run_id") % 41 == 0,
                                                                     F.concat(F.lit("V"), F.col("version_no")))
    reg = runs.select("model", F.coalesce(ver, F.concat(F.lit("v"), F.col("version_no").cast("string"))).alias("version"))
    return R.next_version(reg)


SQL["next_version"] = O.with_views(["runs"], """
SELECT model, 'v' || CAST(coalesce(max(TRY_CAST(regexp_extract(trim(version), '^[vV]?([0-9]+)$', 1) AS BIGINT)), 0) + 1 AS VARCHAR) AS next_version
FROM (SELECT model, CASE WHEN run_id % 37 = 0 THEN 'version-x' WHEN run_id % 41 = 0 THEN 'V' || CAST(version_no AS VARCHAR)
      ELSE 'v' || CAST(version_no AS VARCHAR) END AS version FROM runs) GROUP BY model""")


def register_metrics(spark, sf):
    """RG1: raw metric maps with mixed key spellings -> normalised metric struct (flattened)."""
    runs = FX.runs(spark, sf)
    raw = F.when(F.col("run_id") % 2 == 0,
                 F.create_map(F.lit("rmse"), F.col("rmse"), F.lit("mae"), F.col("rmse") / 2, F.lit("MAPE (%)"), F.lit(12.5))) \
        .otherwise(F.create_map(F.lit("RMSE"), F.col("rmse"), F.lit("R2"), F.lit(0.9)))
    out = runs.select("model", "version_no", R.normalize_metrics(raw).alias("m"))
    return out.select("model", "version_no", "m.MAE", "m.RMSE", "m.R2", "m.MAPE")


SQL["register_metrics"] = O.with_views(["runs"], """
SELECT model, version_no, CASE WHEN run_id % 2 = 0 THEN rmse / 2 ELSE 0.0 END AS MAE, rmse AS RMSE,
  CASE WHEN run_id % 2 = 0 THEN 0.0 ELSE 0.9 END AS R2, CASE WHEN run_id % 2 = 0 THEN 12.5 ELSE 0.0 END AS MAPE FROM runs""")


def model_ranking(spark, sf):
    """ML8/WN7/SO8: latest version of every model ranked by RMSE (1 = best); ties by model name."""
    runs = FX.runs(spark, sf)
    latest = runs.groupBy("model").agg(F.max_by(F.struct("version_no", "rmse"), "version_no").alias("l")) \
        .select("model", "l.version_no", "l.rmse")
    # final ranking over one row per model
    w = Window.orderBy("rmse", "model")
    return latest.withColumn("rank", F.row_number().over(w).cast("bigint"))


SQL["model_ranking"] = O.with_views(["runs"], """
SELECT model, version_no, rmse, CAST(row_number() OVER (ORDER BY rmse, model) AS BIGINT) AS rank FROM (
  SELECT model, arg_max(version_no, version_no) AS version_no, arg_max(rmse, version_no) AS rmse FROM runs GROUP BY model)""")


def best_model(spark, sf):
    """SO8: argmin RMSE over all registered runs (first model name wins ties)."""
    return FX.runs(spark, sf).agg(F.min_by(F.struct("model", "version_no", "rmse"),
                                           F.struct("rmse", "model", "version_no")).alias("b")).select("b.*")


SQL["best_model"] = O.with_views(["runs"], """
SELECT model, version_no, rmse FROM runs ORDER BY rmse, model, version_no LIMIT 1""")


def dataset_version(spark, sf):
    return R.dataset_version(FX.series(spark, sf))


SQL["dataset_version"] = O.with_views(["series"], """
SELECT strftime(min("timestamp"), '%Y-%m-%d') || '_to_' || strftime(max("timestamp"), '%Y-%m-%d') AS dataset_version FROM series""")

QUERIES.update({
    "champion_history": champion_history, "registry_listing": registry_listing,
    "production_version": production_version, "serving_model": serving_model, "rollback": rollback,
    "rollback_then_promote": rollback_then_promote,
    "next_version": next_version, "register_metrics": register_metrics, "model_ranking": model_ranking,
    "best_model": best_model, "dataset_version": dataset_version,
})
