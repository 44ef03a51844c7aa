"""Bucketed fill / rolling windows against a pandas brute force."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from airspark.operators.series import add_positions, series_features


def frame(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for city, n in (("a", 37), ("b", 23), ("c", 11), ("d", 1)):
        hours = sorted(rng.choice(200, size=n, replace=False))  # gaps in time
        for h in hours:
            v = float(rng.integers(0, 100))
            rows.append((city, base + dt.timedelta(hours=int(h)), v))
    pdf = pd.DataFrame(rows, columns=["city", "timestamp", "x"])
    # nulls: leading run for a, trailing run for b, all of c, scattered
    pdf.loc[pdf.city == "a", "x"] = pdf.loc[pdf.city == "a", "x"].where(pdf[pdf.city == "a"].reset_index().index >= 6)
    bmask = pdf.city == "b"
    pdf.loc[bmask, "x"] = pdf.loc[bmask, "x"].where(pdf[bmask].reset_index().index < 15).values
    pdf.loc[pdf.city == "c", "x"] = np.nan
    pdf.loc[pdf.index % 7 == 3, "x"] = np.nan
    return pdf


def brute(pdf):
    out = pdf.sort_values(["city", "timestamp"]).copy()
    out["x"] = out.groupby("city")["x"].transform(lambda s: s.ffill().bfill())
    out["x"] = out["x"].clip(0, 90)
    out["r4"] = out.groupby("city")["x"].transform(lambda s: s.rolling(4, min_periods=1).mean())
    return out.reset_index(drop=True)


def to_spark(spark, pdf):
    p = pdf.copy()
    p["x"] = p["x"].astype(object).where(p["x"].notna(), None)
    return spark.createDataFrame(p, "city string, timestamp timestamp_ntz, x double")


@pytest.mark.parametrize("bucket_rows", [4, 5, 9, 8192])
def test_fill_clip_roll_matches_pandas(spark, bucket_rows):
    pdf = frame()
    got = series_features(to_spark(spark, pdf), fill_cols=["x"], clip_bounds={"x": (0, 90)},
                          rolls=[("r4", "x", 4)], bucket_rows=bucket_rows).toPandas()
    got = got.sort_values(["city", "timestamp"]).reset_index(drop=True)
    exp = brute(pdf)
    assert len(got) == len(exp)
    pd.testing.assert_series_equal(got["x"], exp["x"], check_names=False)
    np.testing.assert_allclose(got["r4"].astype(float), exp["r4"].astype(float), rtol=1e-12, equal_nan=True)


def test_positions_are_exact(spark):
    pdf = frame(1)
    got = add_positions(to_spark(spark, pdf)).toPandas().sort_values(["city", "timestamp"])
    exp = pdf.sort_values(["city", "timestamp"]).groupby("city").cumcount() + 1
    assert list(got["_pos"]) == list(exp)


def test_fill_leaves_no_null_when_city_has_a_value(spark):
    pdf = frame(2)
    got = series_features(to_spark(spark, pdf), fill_cols=["x"], bucket_rows=3).toPandas()
    has_value = pdf.groupby("city")["x"].apply(lambda s: s.notna().any())
    for city, ok in has_value.items():
        assert got[got.city == city]["x"].notna().all() == bool(ok)


def test_bucket_must_exceed_window(spark):
    with pytest.raises(ValueError):
        series_features(to_spark(spark, frame()), rolls=[("r", "x", 24)], bucket_rows=10)


def test_bounded_context_equals_full_recompute(spark):
    """Future rows + 23-row tail + carried prior values give the full-series result."""
    import datetime as dt

    from airspark import schemas as S
    from airspark.plans.features import build_forecast_features, forecast_context_rows
    rng = np.random.default_rng(7)
    rows = []
    for city in ("a", "b"):
        for h in range(150):
            vals = [None if rng.random() < 0.3 else float(rng.integers(0, 80)) for _ in S.RAW_FEATURE_COLUMNS]
            if h < 60:  # long early gap in pm25 so the fill must come from far back
                vals[0] = None if h > 3 else vals[0]
            rows.append((city, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h),
                         dt.datetime(2024, 1, 9), *vals, float(h)))
    schema = ("city string, timestamp timestamp_ntz, ingestion_timestamp timestamp_ntz, "
              + ", ".join(f"{c} double" for c in S.RAW_FEATURE_COLUMNS) + ", us_aqi double")
    obs = spark.createDataFrame(rows, schema)
    as_of = "2024-01-05 12:00:00"
    full = build_forecast_features(obs, as_of, horizon=72, bounded=False)
    ctx, prior = forecast_context_rows(obs, as_of)
    part = build_forecast_features(ctx, as_of, horizon=72, prior=prior)
    default = build_forecast_features(obs, as_of, horizon=72)  # bounded inside
    cols = [c for c in full.columns if c not in ("ingestion_timestamp", "forecast_run_timestamp")]
    assert full.count() == 82  # 41 future hours per city
    for other in (part, default):
        assert full.select(*cols).exceptAll(other.select(*cols)).count() == 0
        assert other.select(*cols).exceptAll(full.select(*cols)).count() == 0
