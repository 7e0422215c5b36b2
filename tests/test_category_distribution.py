"""AG7 on hand-built values: right-closed bands, zero-filled, NULL/NaN counted in the total only."""


def test_category_distribution_hand_computed(spark):
    from aerolith.operators.eda import category_distribution

    vals = [(None,), (10.0,), (50.0,), (51.0,), (300.0,), (301.0,), (float("nan"),)]
    df = spark.createDataFrame(vals, "us_aqi double")
    got = {r["aqi_category"]: (r["band"], r["count"], r["percentage"]) for r in category_distribution(df).collect()}
    assert got == {
        "Good": (1, 2, 28.57),
        "Moderate": (2, 1, 14.29),
        "Unhealthy for Sensitive Groups": (3, 0, 0.0),
        "Unhealthy": (4, 0, 0.0),
        "Very Unhealthy": (5, 1, 14.29),
        "Hazardous": (6, 1, 14.29),
    }
