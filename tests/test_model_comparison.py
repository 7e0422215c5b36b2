"""ML9: model comparison contract (metrics, MAPE, scoring time, one selected best model)."""

import __spark_entry__ as entry
from conftest import SF_SMALL


def test_model_comparison_contract(spark):
    rows = entry.queries()["model_comparison"](spark, SF_SMALL).collect()
    assert sorted(r["model"] for r in rows) == ["GradientBoosting", "RandomForest", "Ridge"]
    selected = [r for r in rows if r["selected"]]
    assert len(selected) == 1
    assert selected[0]["rank"] == 1
    assert selected[0]["rmse"] == min(r["rmse"] for r in rows)
    assert sorted(r["rank"] for r in rows) == [1, 2, 3]
    for r in rows:
        assert r["mape"] is not None and r["mape"] >= 0
        assert r["scoring_seconds"] is not None and r["scoring_seconds"] > 0
        assert r["fit_seconds"] is not None and r["fit_seconds"] > 0
