"""Embedding whitening against plain integer and floating-point arithmetic, and its odd inputs."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolith.llm import whitening as w

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(1, 6), st.sampled_from([1, 5, 1 << 20, 1 << 52]), st.integers(0, 10**6))
def test_scatter_is_exact(rows, dims, size, seed):
    x = np.random.default_rng(seed).integers(-size, size + 1, (rows, dims))
    big = np.concatenate([x.astype(object), np.ones((rows, 1), object)], axis=1)
    assert (w.scatter(x) == big.T @ big).all()


def brute(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = n * fit - s
    cov = (centred.T @ centred) / n**3
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1], vector[:, ::-1]
    return x, n, s, value, vector


def test_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    data = {r["vec_id"]: r["embedding"] for r in rows.collect()}
    x, n, s, value, vector = brute(list(data.values()))
    got = w.op11_embedding_whitening(spark, SF).collect()
    assert len(got) == 16 * len(data)
    at = {v: k for k, v in enumerate(data)}
    signs = {}
    for r in got:
        k, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == int(((n * x[k] - s) ** 2).sum())
        assert r["explained"] == pytest.approx(value[c] / value.sum(), rel=1e-9)
        assert 0 <= r["identity_error"] <= 1e-4
        here = ((x[k] - s / n) @ vector[:, c]) / math.sqrt(value[c])
        if abs(here) > 1e-3:
            assert abs(r["whitened"]) == pytest.approx(abs(here), rel=1e-6)
            assert signs.setdefault(c, r["whitened"] * here > 0) == (r["whitened"] * here > 0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0, 0.0]), (1, [0.5, 1.0, 0.0]), (2, None), (3, [0.0, None, 1.0]), (4, [nan, 0.0, 0.0]), (5, [inf, 0.0, 0.0]), (6, [-inf, 0.0, 0.0]),
            (None, [0.0, -0.25, 0.0]), (7, [0.1, 0.9, 0.0]), (8, []), (9, [1.0]), (10, [1e30, 0.0, 0.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("x", "c", "i", "j", "v", "n", "component", "whitened"):
        df = df.withColumn(c, F.lit(1))
    got = w.whiten(df).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted((k, c) for k in (0, 1, 1, 7, 10) for c in (1, 2, 3))
    assert {r["n"] for r in got} == {4}
    third = [r for r in got if r["component"] == 3]  # the last dimension is constant
    assert all(r["whitened"] is None and r["explained"] == 0 for r in third)
    assert all(r["whitened"] is not None for r in got if r["component"] == 1)
    assert all(r["deviation"] is None for r in got)  # the sum over the vector with 1e30 fits no long
    got = w.whiten(df.where("vec_id is null or vec_id < 10")).collect()
    assert {r["n"] for r in got} == {3} and all(r["deviation"] >= 0 for r in got)


def test_nothing_varies(spark):
    got = w.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, SCHEMA)).collect()
    assert len(got) == 10 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [None])]])
def test_no_rows(spark, rows):
    df = w.whiten(spark.createDataFrame(rows, SCHEMA))
    assert df.count() == 0 and df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_blocks_and_partitions_do_not_matter(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(0, 3, 5)]) for i in range(400)] + [(999, [1.0, 2.0, 3.0, 4.0, 5.0])] * 300
    one = w.whiten(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    many = w.whiten(spark.createDataFrame(rows, SCHEMA).repartition(11)).collect()
    key = lambda r: (r["vec_id"], r["component"])
    assert [tuple(r)[:6] for r in sorted(one, key=key)] == [tuple(r)[:6] for r in sorted(many, key=key)]
    assert one[0]["n"] == 401
