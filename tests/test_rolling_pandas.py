"""WN1/WN2 on random series with NULLs: lags and rolling means equal pandas shift / rolling(min_periods=w)."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd


def test_lags_and_rolling_equal_pandas(spark):
    from aerolith.operators.features import LAGS, ROLLS, add_history_features

    rng = np.random.default_rng(11)
    rows = []
    for city, n in (("a", 60), ("b", 35), ("c", 5)):
        t0 = datetime(2024, 1, 1)
        for i in range(n):
            v = None if rng.random() < 0.15 else float(rng.integers(0, 300))
            rows.append((city, t0 + timedelta(hours=int(i * 1 + (i % 4 == 0))), v))   # irregular gaps: lags stay positional
    df = spark.createDataFrame(rows, "city string, timestamp timestamp, us_aqi double")
    got = add_history_features(df).toPandas().sort_values(["city", "timestamp"]).reset_index(drop=True)

    pdf = pd.DataFrame(rows, columns=["city", "timestamp", "us_aqi"]).sort_values(["city", "timestamp"])
    g = pdf.groupby("city")["us_aqi"]
    for k in LAGS:
        pdf[f"aqi_lag_{k}"] = g.shift(k)
    for w in ROLLS:
        pdf[f"aqi_roll_{w}"] = g.transform(lambda s, w=w: s.rolling(w, min_periods=w).mean())
    pdf = pdf.reset_index(drop=True)
    for c in [f"aqi_lag_{k}" for k in LAGS] + [f"aqi_roll_{w}" for w in ROLLS]:
        np.testing.assert_allclose(got[c].astype(float).to_numpy(), pdf[c].astype(float).to_numpy(),
                                   rtol=0, atol=1e-9, equal_nan=True, err_msg=c)
