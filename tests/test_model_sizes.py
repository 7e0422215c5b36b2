"""The registered tree queries train models of the reference sizes, once per training table."""
import threading

import pytest
from pyspark.sql import functions as F

from aerolith.operators import ml as ML
from aerolith.operators import model_store as MS
from aerolith.plans import catalog
from conftest import SF_SMALL

SIZES = {"random_forest": {"numTrees": 300, "maxDepth": 20}, "gbt": {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05}}
COLS = ML.CATEGORICAL_FEATURES + ML.NUMERIC_FEATURES


class Caught(Exception):
    pass


@pytest.mark.parametrize("name", ["model_training", "model_comparison", "forecast_recursive_tree"])
def test_reference_sizes(spark, monkeypatch, name):
    asked = []

    def train_models(train, specs, **kw):
        asked.extend((s.kind, s.params) for s in specs)
        raise Caught

    def fit_state_model(train, features, kind="ridge", params=None, **kw):
        asked.append((kind, params))
        raise Caught

    monkeypatch.setattr(ML, "train_models", train_models)
    monkeypatch.setattr(ML, "fit_state_model", fit_state_model)
    with pytest.raises(Caught):
        catalog.queries()[name](spark, SF_SMALL)
    trees = [(k, p) for k, p in asked if k != "ridge"]
    assert trees and all(SIZES[k].items() <= p.items() for k, p in trees)


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(200).select(
        *[F.concat(F.lit(c), F.col("id") % 3).alias(c) for c in ML.CATEGORICAL_FEATURES],
        *[(F.sin(F.col("id") * (i + 1)) * 10).alias(c) for i, c in enumerate(ML.NUMERIC_FEATURES)], (F.col("id") % 50 + F.lit(1.0)).alias(ML.TARGET))


SMALL = [ML.ModelSpec("Ridge", "ridge"), ML.ModelSpec("Forest", "random_forest", {"numTrees": 3, "maxDepth": 3, "seed": 1}),
         ML.ModelSpec("Boosting", "gbt", {"maxIter": 3, "maxDepth": 2, "seed": 1}), ML.ModelSpec("Broken", "nothing")]


def test_one_fit_per_table(spark, table, tmp_path):
    """A second call, on the same rows in another order, fits nothing; other rows or parameters do."""
    store = str(tmp_path)
    fitted, first = ML.train_models(table, SMALL, store=store)
    again, second = ML.train_models(table.repartition(5), SMALL, store=store)
    trained = lambda s: sorted((r["model"], r["fit_seconds"]) for r in s.where("status = 'trained'").collect())
    assert trained(first) == trained(second) and len(MS.M.snapshot(spark, store).folders) == 3
    assert {r["model"] for r in second.where("status = 'failed'").collect()} == {"Broken"}
    a, b = (m["Forest"].transform(table).agg(F.sum("prediction")).first()[0] for m in (fitted, again))
    assert a == pytest.approx(b)
    ML.train_models(table.where("day > 0"), SMALL[:1], store=store)
    ML.train_models(table, [ML.ModelSpec("Forest", "random_forest", {"numTrees": 2, "maxDepth": 3, "seed": 1})], store=store)
    assert len(MS.M.snapshot(spark, store).folders) == 5


def test_failed_models_are_rows(spark, table, tmp_path):
    fitted, summary = ML.train_models(table, SMALL, store=str(tmp_path))
    rows = {r["model"]: r for r in ML.compare_models(fitted, table, fit_summary=summary).collect()}
    assert set(rows) == {s.name for s in SMALL} and rows["Broken"]["status"] == "failed" and rows["Broken"]["rmse"] is None
    assert sum(r["selected"] for r in rows.values()) == 1 and all(rows[m]["mape"] is not None for m in fitted)


def test_models_are_fitted_beside_each_other(spark, table, tmp_path, monkeypatch):
    """Two fits at once: each waits for the other to begin. The summary keeps the order of the specs."""
    both, fit_once = threading.Barrier(2, timeout=60), MS.fit_once

    def met(pipeline, train, what, *a):
        if what["kind"] != "gbt":
            both.wait()
        return fit_once(pipeline, train, what, *a)

    monkeypatch.setattr(MS, "fit_once", met)
    fitted, summary = ML.train_models(table, SMALL, store=str(tmp_path))
    assert [(r["model"], r["status"]) for r in summary.collect()] == [
        ("Ridge", "trained"), ("Forest", "trained"), ("Boosting", "trained"), ("Broken", "failed")]
    assert list(fitted) == ["Ridge", "Forest", "Boosting"]


def test_parts_of_a_forest():
    assert [ML.forest_parts(n, 300) for n in (0, 5_000, 5_001, 30_000, 35_000, 10**7)] == [1, 1, 2, 6, 6, 12]
    assert ML.forest_parts(10**7, 7) == 7 and ML.forest_parts(10**7, 13) == 1


def test_forest_in_parts_is_the_mean_of_all_trees(spark, table, tmp_path, monkeypatch):
    """Every tree is grown, no two parts alike, and the stored forest is the one that was fitted."""
    spec = ML.ModelSpec("Forest", "random_forest", {"numTrees": 6, "maxDepth": 4, "seed": 1})
    monkeypatch.setattr(ML, "ROWS_PER_FOREST_PART", 70)   # 200 rows: three parts
    model = ML.train_models(table, [spec], store=str(tmp_path))[0]["Forest"]
    again = ML.train_models(table, [spec], store=str(tmp_path))[0]["Forest"]
    trees = [t for s in model.stages if hasattr(s, "trees") for t in s.trees]
    assert len(trees) == 6 and len({t.toDebugString.split("\n", 1)[1] for t in trees}) == 6
    assert all(s.getMaxDepth() == 4 for s in model.stages if hasattr(s, "trees"))
    rows, same = (m.transform(table).orderBy(*ML.NUMERIC_FEATURES).collect() for m in (model, again))
    assert not any(c.startswith("prediction_") for c in rows[0].asDict())
    for r, s in zip(rows[:20], same[:20], strict=True):
        assert r["prediction"] == pytest.approx(sum(t.predict(r["features"]) for t in trees) / 6) == s["prediction"]
