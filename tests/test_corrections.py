"""Inputs beyond the fixtures: native and ISO times, large integers, empty and constant data, late rows."""

import datetime as dt

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import eda, ml, monitoring, quality, registry, timeseries
from aerolith.sources import io, manifest
from aerolith.streaming import ingest


def test_times(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05.5",), ("2024-01-02 03:04",), ("no time",), (None,)], "x string")
    got = [r[0] for r in df.select(quality.parse_timestamp("x")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 500000), dt.datetime(2024, 1, 2, 3, 4), None, None]
    native = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05.25' AS timestamp, 'a' AS city")
    assert quality.coerce_lenient(native).first()["timestamp"] == dt.datetime(2024, 1, 2, 3, 4, 5, 250000)
    assert quality.require_valid_timestamps(native).count() == 1


def test_integers_above_2_53(spark):
    df = spark.createDataFrame([("9007199254740993", "3.7")], "id string, n string")
    out = quality.strict_cast(df, T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType())])).first()
    assert (out["id"], out["n"]) == (9007199254740993, 3)


def test_constant_and_empty(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    assert monitoring.regression_metrics(flat, "y", "p").first()["r2"] is None
    bins = eda.histogram(flat, "y").collect()
    assert [(r["bin"], r["count"]) for r in bins] == [(0, 2)]
    assert eda.histogram(flat.where("false"), "y").count() == 0


def test_r2_does_not_cancel(spark):
    df = spark.range(100).select((F.lit(1e9) + F.col("id") / 100).alias("y"), (F.lit(1e9) + F.col("id") / 100 + 0.01).alias("p"))
    assert abs(monitoring.regression_metrics(df, "y", "p", digits=None).first()["r2"] - (1 - 1e-4 / 0.083325)) < 1e-4


def test_few_rows_are_split(spark):
    df = spark.range(5).select(F.timestamp_seconds(F.col("id")).alias("timestamp"), F.lit("a").alias("city"))
    n = {r["split"]: r["count"] for r in monitoring.chronological_split(df).groupBy("split").count().collect()}
    assert n == {"reference": 4, "current": 1}


def test_late_row_does_not_win(spark, tmp_path):
    row = lambda city, t, v: (city, dt.datetime(2024, 1, t), v)
    schema = T._parse_datatype_string("city string, timestamp timestamp_ntz, v double")
    for batch, rows in enumerate([[row("a", 2, 20.0)], [row("a", 1, 10.0)]]):
        manifest.append_batch(spark.createDataFrame(rows, schema).withColumn("batch_id", F.lit(batch).cast("long")), str(tmp_path), batch)
    newest = ingest.merge_batches(spark, str(tmp_path), schema, ["city"], ["timestamp"]).collect()
    assert [r["v"] for r in newest] == [20.0]
    last = ingest.merge_batches(spark, str(tmp_path), schema, ["city"], ["timestamp"], arrival=True).collect()
    assert [r["v"] for r in last] == [10.0]
    first = ingest.merge_batches(spark, str(tmp_path), schema, ["city"], ["timestamp"], arrival=True, newest=False).collect()
    assert [r["v"] for r in first] == [20.0]


def test_latest_value_of_the_hour(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, m), v) for m, v in ((50, 5.0), (10, 1.0), (55, None))],
                               "city string, timestamp timestamp_ntz, us_aqi double").repartition(3)
    assert [r["us_aqi"] for r in timeseries.hourly_grid(df).collect()] == [5.0]


def test_better_version_after_rollback(spark):
    runs = spark.createDataFrame([("m", 1, 9.0), ("m", 2, 5.0), ("m", 3, 7.0), ("m", 4, 8.0), ("k", 1, 1.0)], "model string, version_no long, rmse double")
    back = lambda after: spark.createDataFrame([("m", 1, after), ("k", 7, 9)], "model string, version_no long, after long")
    got = lambda after: {(r["model"], r["version_no"]): r["status"] for r in registry.registry_status(runs, rollback=back(after)).collect()}
    # after version 2 only version 1 is in production again, so version 3 beats it and version 4 does not beat 3
    assert got(2) == {("m", 1): "archived", ("m", 2): "archived", ("m", 3): "production", ("m", 4): "candidate", ("k", 1): "production"}
    assert got(4) == {("m", 1): "production", ("m", 2): "archived", ("m", 3): "candidate", ("m", 4): "candidate", ("k", 1): "production"}


def test_keys_unique_over_inserts(spark):
    path = io.scratch_dir(spark, "inserts")
    for seq in (1, 0):
        io.keyed_insert(spark.createDataFrame([("a", seq, 10.0 + seq), ("b", seq, 20.0 + seq)], "city string, ingest_seq int, v double"), path, ("city",))
    got = io.read_keyed(spark, path, "city string, ingest_seq int, v double").collect()
    assert sorted(map(tuple, got)) == [("a", 1, 11.0), ("b", 1, 21.0)]


def test_unknown_category_has_no_slot(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "city string, x double")
    model = Pipeline(stages=ml.preprocessor_stages(["city"], ["x"])).fit(train)
    rows = model.transform(spark.createDataFrame([("a", 1.0), ("z", 3.0), (None, 4.0)], "city string, x double")).collect()
    assert [r["features"].toArray().tolist() for r in rows] == [[1.0, 1.0, 0.0], [3.0, 0.0, 0.0], [4.0, 0.0, 0.0]]
