"""PSI/TVD properties, decision tables and registry promotion rules."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from aerolith.operators import monitoring as M
from aerolith.operators.ranking import exact_quantiles


def _split_df(spark, ref, cur, name="x"):
    rows = [("reference", float(v)) for v in ref] + [("current", float(v)) for v in cur]
    return spark.createDataFrame(rows, f"split string, {name} double")


def _psi(spark, ref, cur):
    r = M.psi_report(_split_df(spark, ref, cur), ["x"], digits=None).first()
    return r["psi"], r["status"]


def _pandas_psi(ref, cur, bins=10, eps=1e-6):
    ref, cur = pd.Series(ref, dtype=float), pd.Series(cur, dtype=float)
    edges = np.unique(ref.quantile(np.linspace(0, 1, bins + 1)).to_numpy()).astype(float)
    edges[0], edges[-1] = -np.inf, np.inf
    rc = pd.cut(ref, edges, include_lowest=True).value_counts(sort=False)
    cc = pd.cut(cur, edges, include_lowest=True).value_counts(sort=False).reindex(rc.index, fill_value=0)
    rp = (rc / max(rc.sum(), 1)).clip(lower=eps)
    cp = (cc / max(cc.sum(), 1)).clip(lower=eps)
    return float(((cp - rp) * np.log(cp / rp)).sum())


def test_psi_matches_pandas_recipe(spark):
    rng = np.random.default_rng(7)
    ref, cur = rng.normal(50, 10, 400).round(2), rng.normal(55, 12, 150).round(2)
    got, _ = _psi(spark, ref, cur)
    assert abs(got - _pandas_psi(ref, cur)) < 1e-9


def test_psi_identical_is_zero(spark):
    x = list(range(100))
    assert abs(_psi(spark, x, x)[0]) < 1e-12


def test_psi_constant_reference(spark):
    assert _psi(spark, [5] * 20, [5] * 7) == (0.0, "NO_DRIFT")
    psi, status = _psi(spark, [5] * 20, [5, 6, 7])
    assert psi == float("inf") and status == "DRIFT"


def test_psi_mostly_zero_feature_single_bin(spark):
    ref = [0.0] * 95 + [1.0, 2.0, 3.0, 4.0, 5.0]
    assert abs(_psi(spark, ref, [0.0] * 10 + [9.0])[0]) < 1e-12


def test_tvd_identical_and_disjoint(spark):
    same = spark.createDataFrame([("reference", "a"), ("reference", "b"), ("current", "a"), ("current", "b")],
                                 "split string, c string")
    assert M.tvd_report(same, ["c"]).first()["value"] == 0.0
    disj = spark.createDataFrame([("reference", "a"), ("current", "b")], "split string, c string")
    assert M.tvd_report(disj, ["c"]).first()["value"] == 1.0


def _decision(spark, rmse, drift_pct, change_pct):
    row = spark.createDataFrame([(rmse, drift_pct, change_pct, 30.0, "DRIFT_DETECTED")],
                                "rmse double, drift_percentage double, rmse_change_percentage double, threshold double, overall_status string")
    return M.retrain_decision(row).first()


def test_retrain_decision_table(spark):
    assert _decision(spark, 30.0, 0.0, 0.0)["retraining_required"] is True
    d = _decision(spark, 6.0, 35.0, 0.0)
    assert d["retraining_required"] is False and d["seasonal_or_covariate_drift_only"] is True
    assert _decision(spark, 6.0, 35.0, 12.0)["retraining_required"] is True


def test_registry_equal_rmse_not_promoted(spark):
    from aerolith.operators.registry import champion_history, registry_status
    runs = spark.createDataFrame([("m", 1, 5.0), ("m", 2, 5.0), ("m", 3, 4.0)], "model string, version_no int, rmse double")
    st = {r["version_no"]: r["status"] for r in registry_status(champion_history(runs)).collect()}
    assert st == {1: "archived", 2: "candidate", 3: "production"}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.integers(0, 20, 300), rng.normal(0, 1, 77).round(3)])
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(vals)], "g int, v double")
    probs = [0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["quantiles"] for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in range(3):
        exp = np.quantile(vals[np.arange(len(vals)) % 3 == g], probs)
        assert np.allclose(got[g], exp, atol=1e-9)


def test_global_split_exact_count(spark):
    df = spark.range(0, 1003).select(F.col("id"), (F.col("id") % 7).alias("city"), F.floor(F.col("id") / 7).alias("timestamp"))
    out = M.chronological_split(df, ("timestamp", "city"), 0.8)
    ref = [r["id"] for r in out.filter("split = 'reference'").collect()]
    assert len(ref) == int(1003 * 0.8) and max(ref) < min(r["id"] for r in out.filter("split = 'current'").collect())


def test_feature_without_values_is_reported(spark):
    """An all-NULL feature, a feature of NaN, and an empty table: UNAVAILABLE rows, percentages over all features."""
    rows = [("reference" if i < 80 else "current", float(i % 10), None, float("nan"), "a" if i % 2 else "b", None) for i in range(100)]
    df = spark.createDataFrame(rows, "split string, x double, gone double, nan double, c string, none string")
    psi = {r["feature"]: r for r in M.psi_report(df, ["x", "gone", "nan"]).collect()}
    assert set(psi) == {"x", "gone", "nan"} and psi["x"]["status"] == "NO_DRIFT"
    assert all(psi[f]["status"] == "UNAVAILABLE" and psi[f]["psi"] is None and psi[f]["reference_samples"] == 0 for f in ("gone", "nan"))
    tvd = {r["feature"]: r["status"] for r in M.tvd_report(df, ["c", "none"]).collect()}
    assert tvd == {"c": "NO_DRIFT", "none": "UNAVAILABLE"}
    s = M.drift_summary(M.psi_report(df, ["x", "gone", "nan"])).first()
    assert (s["numeric_features"], s["unavailable_features"], s["drift_percentage"]) == (3, 2, 0.0)
    empty = M.psi_report(df.where("false"), ["x"])
    assert [r["status"] for r in empty.collect()] == ["UNAVAILABLE"]
    none = M.drift_summary(empty.where("false")).first()
    assert none["numeric_features"] == 0 and none["drift_percentage"] is None and none["mean_psi"] is None


def test_split_over_many_times(spark, monkeypatch):
    """More distinct times than one task may hold: the same split, by ranges."""
    from pyspark.sql import functions as F
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") % 250).alias("timestamp"), F.concat(F.lit("c"), F.col("id") % 7).alias("city"), "id")
    key = lambda d: {(r["timestamp"], r["city"], r["id"]): r["split"] for r in d.collect()}
    want = key(M.chronological_split(df, ("timestamp", "city", "id")))
    monkeypatch.setattr(M, "MOST_TIMES", 10)
    assert key(M.chronological_split(df, ("timestamp", "city", "id"))) == want and list(want.values()).count("reference") == 400
