"""JN4 as-of lookup on hand-built rows: ties, carry across chunks, fallback to the first value, kept columns."""

from datetime import datetime


def test_asof_edge_cases(spark):
    from aerolith.operators.timeseries import asof_lookup

    t = lambda h, m=0: datetime(2024, 1, 1, h, m)
    hist = spark.createDataFrame([("a", t(2), 10.0), ("a", t(5, 30), 20.0), ("a", t(6), None), ("b", t(1), 7.0)],
                                 "city string, timestamp timestamp_ntz, us_aqi double")
    probes = spark.createDataFrame([
        (1, "a", t(1), "before-first"),      # before any history -> first value 10
        (2, "a", t(2), "exact-time"),        # at a history time -> that value 10
        (3, "a", t(4, 59), "carried"),       # chunk 4h has no history -> carried 10
        (4, "a", t(5, 45), "same-chunk"),    # after 5:30 in the same chunk -> 20
        (5, "a", t(9), "after-null"),        # NULL history values are ignored -> 20
        (6, "b", t(0), "other-entity"),      # -> 7
        (7, "c", t(0), "unknown-entity"),    # no history -> NULL
    ], "probe_id bigint, city string, probe_ts timestamp_ntz, label string")
    out = {r["probe_id"]: r for r in asof_lookup(probes, hist).collect()}
    assert {k: out[k]["asof_value"] for k in out} == {1: 10.0, 2: 10.0, 3: 10.0, 4: 20.0, 5: 20.0, 6: 7.0, 7: None}
    assert out[3]["label"] == "carried" and out[3]["city"] == "a"
    assert asof_lookup(probes, hist).columns == probes.columns + ["asof_value"]
