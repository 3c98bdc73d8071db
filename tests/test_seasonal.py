"""The seasonal model recovers planted trends, bends, waves and regressors, and its interval covers."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators import seasonal as sn

DAYS = np.array([(dt.date(2000 + m // 12, m % 12 + 1, 1) - dt.date(1970, 1, 1)).days for m in range(120)], dtype=float)


def fit(spec, series, train=96, extra=None):
    y = np.stack(series)
    day = np.broadcast_to(DAYS[:y.shape[1]], y.shape).copy()
    known = np.broadcast_to(np.arange(y.shape[1]) < train, y.shape)
    return sn.Fit(spec, day, y, known, np.zeros((*y.shape, 0)) if extra is None else extra).predict()


def wave(k=1, shift=0.0):
    return np.sin(2 * np.pi * k * DAYS / sn.YEAR_DAYS + shift)


def test_additive_trend_and_waves():
    t = np.arange(120) / 120
    plain, lively = 5 + 2 * t + wave(), 3 - t + 0.5 * wave(2, 1.0) + 0.2 * wave(3)
    got, half = fit(sn.SeasonalSpec(yearly_order=4), [plain, lively])
    assert np.abs(got[0, 96:] - plain[96:]).max() < 0.1 and np.abs(got[1, 96:] - lively[96:]).max() < 0.1
    assert (half < 0.1).all()


def test_changepoint_is_found_and_penalised():
    t = np.arange(120) / 100
    bend = 2 + t + 6 * np.maximum(t - 0.4, 0)
    loose, _ = fit(sn.SeasonalSpec(changepoint_scale=0.5, yearly_order=1), [bend])
    stiff, _ = fit(sn.SeasonalSpec(changepoint_scale=1e-7, yearly_order=1), [bend])
    assert np.abs(loose[0] - bend).max() < 0.25 < np.abs(stiff[0] - bend).max()


def test_multiplicative_swing_grows_with_the_level():
    t = np.arange(120) / 120
    y = (2 + 8 * t) * (1 + 0.4 * wave())
    multi, _ = fit(sn.SeasonalSpec("multiplicative", 0.05, yearly_order=2), [y])
    added, _ = fit(sn.SeasonalSpec("additive", 0.05, yearly_order=2), [y])
    assert np.abs(multi[0, 96:] - y[96:]).max() < 0.4 < np.abs(added[0, 96:] - y[96:]).max()


def test_monthly_waves_and_regressors():
    rng = np.random.default_rng(4)
    r = rng.normal(size=120)
    y = 4 + 0.5 * np.sin(2 * np.pi * DAYS / sn.MONTH_DAYS) + 0.7 * r
    extra = np.stack([r, np.full(120, 9.0)], axis=1)[None]  # the second is constant: no effect
    got, _ = fit(sn.SeasonalSpec(monthly=True, regressors=("r", "c"), yearly_order=1), [y], extra=extra)
    without, _ = fit(sn.SeasonalSpec(yearly_order=1), [y])
    assert np.abs(got[0, 96:] - y[96:]).mean() < 0.15 < np.abs(without[0, 96:] - y[96:]).mean()


def test_interval_covers_its_share():
    rng = np.random.default_rng(5)
    series = [3 + np.arange(120) / 60 + wave(1, k) + rng.normal(scale=0.5, size=120) for k in range(60)]
    got, half = fit(sn.SeasonalSpec(yearly_order=2), series)
    inside = np.abs(got - np.stack(series)) <= half
    assert 0.74 < inside[:, :96].mean() < 0.86 and 0.65 < inside[:, 96:].mean() < 0.9


def test_short_and_constant_series_stay_finite():
    for n in (5, 7, 13):
        y = [np.r_[np.ones(n - 1), 2.0], np.zeros(n), np.linspace(0, 1, n)]
        for spec in sn.VARIANTS.values():
            extra = np.ones((3, n, len(spec.regressors)))
            got, half = fit(spec, y, train=n - 1, extra=extra)
            assert np.isfinite(got).all() and np.isfinite(half).all()


@pytest.mark.parametrize("name", ["final", "v2"])
def test_frames_follow_the_variant(spark, name):
    spec = sn.VARIANTS[name]
    rows = [(e, dt.date(2000 + m // 12, m % 12 + 1, 1), float(max(0, (m % 12 - 3)) * (1 + k)), 1.0) for k, e in enumerate("AB") for m in range(60)]
    rows += [("C", dt.date(2000, 1, 1), 5.0, 1.0)]  # too short
    df = spark.createDataFrame(rows, f"entity string, date date, {spec.target} double, extra double").repartition(3)
    f = sn.seasonal_forecasts(df, spec)
    assert {r.entity for r in f.select("entity").distinct().collect()} == {"A", "B"}
    scores = {r.entity: r for r in sn.seasonal_scores(f, spec).collect()}
    n = 40 if spec.positives_only else 60
    assert scores["A"].n_train == int(n * 0.8) and scores["A"].n_test == n - int(n * 0.8)
    assert scores["A"].mae < 2.0 and scores["B"].mape is not None
    assert f.where(F.col("lower") > F.col("upper")).count() == 0
