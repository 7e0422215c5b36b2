"""Approximate quantile option: rank error within the sketch's bound; PSI report keeps its shape."""

import numpy as np

from conftest import SF_SMALL


def test_approx_quantiles_rank_bound(spark):
    from aerolith.operators.ranking import approx_quantiles
    from aerolith.sources import fixtures as FX

    probs = [0.1, 0.5, 0.9]
    accuracy = 50                                    # coarse on purpose: the bound must still hold
    scored = FX.scored(spark, SF_SMALL)
    got = {r["city"]: r for r in approx_quantiles(scored, ["city"], "pm2_5", probs, accuracy).collect()}
    pdf = scored.select("city", "pm2_5").toPandas()
    for city, g in pdf.groupby("city"):
        vals = np.sort(g["pm2_5"].to_numpy())
        n = len(vals)
        assert got[city]["n"] == n
        for p, q in zip(probs, got[city]["quantiles"]):
            lo = np.searchsorted(vals, q, side="left")      # ranks held by the returned value
            hi = np.searchsorted(vals, q, side="right")
            target = p * n
            assert lo - n / accuracy - 1 <= target <= hi + n / accuracy + 1


def test_psi_report_with_approx_edges(spark):
    from pyspark.sql import functions as F

    from aerolith.operators import monitoring as M
    from aerolith.plans.q_monitoring import NUMERIC, split_table

    t = split_table(spark, SF_SMALL)
    exact = {r["feature"]: r for r in M.psi_report(t, NUMERIC).collect()}
    approx = {r["feature"]: r for r in M.psi_report(t, NUMERIC, accuracy=10000).collect()}
    assert set(exact) == set(approx) == set(NUMERIC)
    for f in NUMERIC:
        assert exact[f]["reference_samples"] == approx[f]["reference_samples"]
        assert exact[f]["current_samples"] == approx[f]["current_samples"]
        e, a = exact[f]["psi"], approx[f]["psi"]
        assert (e is None) == (a is None)
        if e is not None and np.isfinite(e):
            assert np.isfinite(a) and a >= 0
    assert t.filter(F.col("split") == "reference").count() > 0
