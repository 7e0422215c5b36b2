"""Registered versions: stored rows, concurrent registrations, rollback, scoring by the version in production."""
import threading

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from aerolith.operators import model_store as MS
from aerolith.plans import q_monitoring as QM


def line(spark, slope):
    df = spark.range(50).select(F.col("id").cast("double").alias("us_aqi"), (F.col("id") * slope).cast("double").alias("target_aqi"))
    return Pipeline(stages=[VectorAssembler(inputCols=["us_aqi"], outputCol="features"), LinearRegression(labelCol="target_aqi")]).fit(df)


@pytest.fixture(scope="module")
def good(spark):
    return line(spark, 1.0)


def test_register_promote_roll_back(spark, good, tmp_path):
    path = str(tmp_path)
    assert [MS.register(spark, path, "m", good, {"rmse": r}, "d1") for r in (5.0, 7.0, 3.0)] == ["v1", "v2", "v3"]
    assert MS.register(spark, path, "k", good, {"RMSE": 1.0, "MAPE (%)": 2.0}, "d2") == "v1"
    status = {(r["model"], r["version"]): r["status"] for r in MS.versions(spark, path).collect()}
    assert status == {("m", "v1"): "archived", ("m", "v2"): "candidate", ("m", "v3"): "production", ("k", "v1"): "production"}
    prod = MS.production(spark, path, "m")
    assert prod.row["version"] == "v3" and prod.row["metrics"]["RMSE"] == 3.0 and prod.row["dataset_version"] == "d1"
    MS.roll_back(spark, path, "m", 1)
    assert MS.production(spark, path, "m").row["version"] == "v1"
    MS.register(spark, path, "m", good, {"RMSE": 4.5}, "d3")   # better than version 1, not than 3
    assert MS.production(spark, path, "m").row["version"] == "v4"
    with pytest.raises(LookupError):
        MS.production(spark, path, "nobody")


def test_concurrent_registrations_get_different_versions(spark, good, tmp_path):
    got, errors = [], []

    def run(i):
        try:
            got.append(MS.register(spark, str(tmp_path), "m", good, {"RMSE": float(i)}, "d"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors and sorted(got) == ["v1", "v2", "v3", "v4"]
    rows = MS.versions(spark, str(tmp_path)).collect()
    assert sorted(r["version"] for r in rows) == sorted(got) and len({r["path"] for r in rows}) == 4


def test_a_degraded_model_raises_the_alarm(spark, good, tmp_path):
    """The stored pipeline scores, not a stand-in: a version that is 40 off alerts, the one before it does not."""
    t = spark.range(100, 150).select(F.lit("current").alias("split"), F.col("id").cast("double").alias("us_aqi"), F.col("id").cast("double").alias("target_aqi"))
    path = str(tmp_path)
    MS.register(spark, path, "m", good, {"RMSE": 2.0}, "d")
    fine = QM.performance(t, MS.production(spark, path, "m")).first()
    assert fine["performance_status"] == "NORMAL" and fine["rmse"] < 1 and fine["registered_rmse"] == 2.0
    MS.register(spark, path, "m", line(spark, 1.5), {"RMSE": 1.0}, "d")   # looked better when it was registered
    bad = QM.performance(t, MS.production(spark, path, "m")).first()
    assert bad["performance_status"] == "ALERT" and bad["rmse"] > 30 and bad["rmse_change_percentage"] > 1000
