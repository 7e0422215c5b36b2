"""Exact quantiles by brackets: narrow brackets, ties, signs and hot groups against numpy; no range exchange."""

import numpy as np
import pytest

from aerolith.operators.monitoring import psi_report
from aerolith.operators.ranking import exact_quantiles

PROBS = [0.0, 0.03, 0.1, 0.25, 0.5, 0.77, 0.9, 0.999, 1.0]


def _values(kind: str, n: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    return {"smooth": rng.normal(0, 100, n), "ties": rng.integers(-5, 5, n).astype(float),
            "hot": np.where(rng.random(n) < 0.6, 3.0, rng.exponential(10, n)),
            "infinite": np.concatenate([[np.inf, -np.inf], rng.normal(0, 1, n - 2)]), "constant": np.full(n, -2.5)}[kind]


@pytest.mark.parametrize("accuracy", [50, 400, 10000])
def test_brackets_match_numpy(spark, accuracy):
    rows, want = [], {}
    for kind, n in (("smooth", 6000), ("ties", 5000), ("hot", 9000), ("infinite", 3000), ("constant", 700)):
        v = _values(kind, n)
        rows += [(kind, float(x)) for x in v]
        s = np.sort(v)
        at = np.array(PROBS) * (n - 1)
        lo, hi, part = s[np.floor(at).astype(int)], s[np.ceil(at).astype(int)], at - np.floor(at)
        want[kind] = [float(a) if p == 0 else float(a + (b - a) * p) for a, b, p in zip(lo, hi, part)]
    rows += [("smooth", None), ("hot", float("nan")), (None, 1.0), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", PROBS, accuracy).collect()}
    assert set(got) == set(want)
    for g, q in want.items():
        inner = slice(1, -1) if g == "infinite" else slice(None)   # inf - inf at the ends is not a number
        assert got[g]["quantiles"][inner] == pytest.approx(q[inner], rel=1e-12, abs=1e-12), g
    one = exact_quantiles(df.filter("g = 'hot'"), [], "v", PROBS, accuracy).collect()
    assert one[0]["quantiles"] == pytest.approx(want["hot"], rel=1e-12, abs=1e-12) and one[0]["n"] == 9000
    assert exact_quantiles(df.filter("g = 'none'"), [], "v", PROBS, accuracy).count() == 0


def test_drift_plan_has_no_range_exchange_but_the_report_order(spark):
    df = spark.range(2000).selectExpr("IF(id < 1500, 'reference', 'current') AS split", "double(id % 97) AS a", "double(id * 7 % 1013) AS b")
    plan = psi_report(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning(") <= 1 and "REPARTITION_BY" not in plan and "Scan ExistingRDD" not in plan
