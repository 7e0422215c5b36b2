"""Forecast contract and array-state recursion vs a naive hourly-series recursion."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

import __spark_entry__ as entry
from aerolith.operators import forecast, timeseries
from conftest import SF_SMALL


def test_forecast_contract(spark):
    fc = entry.queries()["forecast_recursive"](spark, SF_SMALL).toPandas()
    for _, g in fc.groupby("city"):
        assert sorted(g["forecast_step"]) == list(range(1, 25))
        assert sorted(g["hours_ahead"]) == list(range(3, 73, 3))
        assert g["data_source"].nunique() == 1
    assert ((fc["predicted_aqi"] >= 0) & (fc["predicted_aqi"] <= 500)).all()
    assert set(fc["data_source"]) <= {"REALTIME", "HISTORICAL_FALLBACK"}


def _naive(history: pd.Series, alpha: float, beta: float, steps=24) -> list[float]:
    """Reference-style recursion on an explicit hourly series with persistence fill."""
    h = history.copy()
    last = h.index[-1]
    prev_ts, prev_val, out = last, h.iloc[-1], []
    for step in range(1, steps + 1):
        ft = last + pd.Timedelta(hours=3 * step)
        t = prev_ts + pd.Timedelta(hours=1)
        while t < ft:
            h.loc[t] = prev_val
            t += pd.Timedelta(hours=1)
        h = h.sort_index()
        roll3 = np.mean([h.loc[ft - pd.Timedelta(hours=k)] for k in (1, 2, 3)])
        p = min(max(alpha + beta * roll3, 0.0), 500.0)
        h.loc[ft] = p
        prev_ts, prev_val = ft, p
        out.append(p)
    return out


def test_array_state_equals_naive_recursion(spark):
    from pyspark.sql import functions as F

    from aerolith.operators import forecast as FC
    idx = pd.date_range("2024-01-01", periods=40, freq="h")
    vals = (np.sin(np.arange(40) / 3) * 30 + 80).round()
    pdf = pd.DataFrame({"city": "a", "timestamp": idx, "us_aqi": vals})
    grid = spark.createDataFrame(pdf).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    seeds = FC.seed_state(grid)
    alpha, beta = 5.0, 0.93
    fc = FC.recursive_forecast(seeds, FC.roll3_linear_step(F.lit(alpha), F.lit(beta))).orderBy("forecast_step").toPandas()
    naive = _naive(pd.Series(vals, index=idx), alpha, beta)
    assert np.allclose(fc["predicted_aqi"].to_numpy(), np.round(naive, 2), atol=0.011)


def test_rejects_have_reasons_and_no_seeds(spark):
    hours = lambda city, n, first=0: [(city, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 50.0 if i >= first else None) for i in range(n)]
    rows = hours("full", 22) + hours("short", 21) + hours("late", 30, first=9) + hours("just", 30, first=8) + hours("blank", 30, first=99)
    series = spark.createDataFrame(rows, "city string, timestamp timestamp_ntz, us_aqi double")
    entities = series.select("city").union(spark.createDataFrame([("unseen",), (None,)], "city string"))
    got = {r["city"]: (r["hours"], r["reason"]) for r in forecast.forecast_rejects(entities, series).collect()}
    assert got == {"short": (21, "TOO_FEW_HOURS"), "late": (30, "MISSING_VALUE"), "blank": (30, "MISSING_VALUE"), "unseen": (0, "NO_DATA")}
    seeded = {r["city"] for r in forecast.seed_state(timeseries.hourly_grid(series)).collect()}
    assert seeded == {"full", "just"}


def test_full_input_recursion_against_a_plain_loop(spark):
    """Held columns stay, the calendar follows each step, the state takes the predictions."""
    last, held, state = dt.datetime(2024, 3, 1, 20), {"pm2_5": 12.5}, [float(40 + (i * 7) % 23) for i in range(24)]
    features = ["pm2_5", *forecast.CALENDAR_INPUTS, "us_aqi", "aqi_lag_1", "aqi_lag_3", "aqi_lag_6", "aqi_lag_24",
                "aqi_roll_3", "aqi_roll_6", "aqi_roll_24"]
    weights = [0.4, 0.3, -0.2, 1.5, 6.0, 0.11, 0.12, 0.05, 0.04, 0.03, 0.2, 0.1, 0.15]
    seeds = spark.createDataFrame([("x", last, state, 12.5)], "city string, last_timestamp timestamp_ntz, state array<double>, pm2_5 double")
    step = forecast.linear_step(F.lit(2.0), [F.lit(w) for w in weights], features, ["pm2_5"])
    got = [r["predicted_aqi"] for r in forecast.recursive_forecast(seeds, step).orderBy("forecast_step").collect()]
    h, want = list(state), []
    for i in range(1, 25):
        at = last + dt.timedelta(hours=3 * i)
        x = [held["pm2_5"], at.hour, at.day, at.month, int(at.weekday() >= 5), h[-1], h[-1], h[-3], h[-6], h[-24],
             sum(h[-3:]) / 3, sum(h[-6:]) / 6, sum(h) / 24]
        p = min(max(2.0 + sum(w * v for w, v in zip(weights, x)), 0.0), 500.0)
        want.append(p)
        h = h[3:] + [p] * 3
    assert got == [round(p, 2) for p in want] or max(abs(a - b) for a, b in zip(got, want)) < 0.0051


def test_source_needs_a_complete_latest_row(spark):
    hours = spark.range(30).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id)) AS timestamp", "id")
    hist = hours.selectExpr("explode(array('ok', 'gap')) AS city", "timestamp", "double(id) AS us_aqi")
    rt = hist.selectExpr("city", "timestamp", "IF(city = 'gap' AND us_aqi = 29, NULL, us_aqi) AS us_aqi")
    got = {(r["city"], r["data_source"]) for r in timeseries.source_preference(rt, hist).select("city", "data_source").distinct().collect()}
    assert {c: s.startswith("REAL") for c, s in got} == {"ok": True, "gap": False} and len(got) == 2
    h = forecast.held_row(rt.withColumnRenamed("us_aqi", "v"), ["v"]).collect()
    assert {r["city"]: r["v"] for r in h} == {"ok": 29.0, "gap": 28.0}
