"""Distributed exact quantiles against numpy (forced multi-pass narrowing)."""

import numpy as np
import pandas as pd
import pytest

from airspark.operators.median import exact_quantiles, median_impute


@pytest.mark.parametrize("n,max_collect,k,error", [(1, 10, 8, 0.1), (2, 10, 8, 0.1), (101, 7, 16, 0.05), (400, 25, 8, 0.01), (1000, 50_000, 4096, 0.003)])
def test_exact_quantiles_match_numpy(spark, n, max_collect, k, error):
    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(50, 20, size=n), 1)  # ties on purpose
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    probs = (0.1, 0.25, 0.5, 0.75, 0.9)
    got = exact_quantiles(df, ["v"], probs, max_collect=max_collect, k=k, error=error)["v"]
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12, abs=1e-12)


def test_median_impute_whole_frame_and_all_null(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None), (4.0, None)], "a double, b double")
    got = median_impute(df, ["a", "b"]).collect()
    assert [r["a"] for r in got] == [1.0, 2.0, 2.0, 4.0]
    assert all(r["b"] == 0.0 for r in got)


def test_median_impute_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "a double")
    assert [r["a"] for r in median_impute(df, ["a"]).collect()] == [1.0, 2.0, 3.0]


def test_fetch_budget_forces_extra_rounds(spark):
    rng = np.random.default_rng(3)
    data = {c: np.round(rng.uniform(0, 100, size=300), 2) for c in ("a", "b", "c")}
    df = spark.createDataFrame(pd.DataFrame(data))
    got = exact_quantiles(df, list(data), (0.2, 0.5, 0.8), max_collect=40, k=16, error=0.1, max_fetch_total=45)
    for c, vals in data.items():
        for p in (0.2, 0.5, 0.8):
            assert got[c][p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)


def test_infinities_and_tiny_ranges_end(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    cols = {"a": [*rng.normal(size=99), float("inf"), float("-inf")],
            "b": [float("inf")] * 60 + [float("-inf")] * 41,
            "c": [*rng.choice([5e-324, 1e-323, 1.5e-323], 101)],
            "d": [*(rng.uniform(-1, 1, size=99) * 1e308), -1.7e308, 1.7e308]}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*cols.values())], "a double, b double, c double, d double")
    probs = (0.0, 0.1, 0.5, 1.0)
    got = exact_quantiles(df, list(cols), probs, max_collect=10, k=16, error=0.05)
    for c, v in cols.items():
        v = sorted(v)
        assert [got[c][p] for p in probs] == [v[0], v[10], v[50], v[100]]


def test_median_impute_takes_nan_as_missing(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", nan), ("a", 1.0), ("a", 3.0), ("a", 5.0)], "city string, x double")
    for by in (None, ["city"]):
        assert sorted(r.x for r in median_impute(df, ["x"], by=by).collect()) == [1.0, 3.0, 3.0, 5.0]


def test_a_heavy_value_is_counted_not_fetched(spark):
    """Two thirds of all rows are one value; the fetched ones are few."""
    from airspark.operators import median as M
    df = spark.range(60_000).selectExpr("CASE WHEN id % 3 = 0 THEN id / 60000 ELSE 0.25 END AS v")
    want = np.quantile([i / 60000 if i % 3 == 0 else 0.25 for i in range(60_000)], [0.05, 0.3, 0.5, 0.9])
    got = exact_quantiles(df, ["v"], (0.05, 0.3, 0.5, 0.9), max_collect=400)["v"]
    assert [got[p] for p in (0.05, 0.3, 0.5, 0.9)] == want.tolist()
    assert M.BRACKETS_A_SCAN >= 171  # all deciles of all model features in one scan


def test_three_scans_without_explode(spark, monkeypatch):
    from airspark.operators import median as M
    scans = []
    inner = M._scan
    monkeypatch.setattr(M, "_scan", lambda *a: scans.append(len(a[1])) or inner(*a))
    df = spark.range(200_000).selectExpr("rand(3) AS a", "rand(4) * 1e6 AS b")
    got = exact_quantiles(df, ["a", "b"], tuple(i / 10 for i in range(1, 10)))
    values = df.toPandas()
    assert scans == [18]  # one scan behind the one that sketches
    for c in "ab":
        assert [got[c][i / 10] for i in range(1, 10)] == [float(np.quantile(values[c], i / 10)) for i in range(1, 10)]
