"""The forecast's sparse trend, its band and its history rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerlens.operators import forecast
from ledgerlens.plans import catalog


def series(values, name="ALL"):
    days = pd.date_range("2022-01-01", periods=len(values))
    return pd.DataFrame({"series": name, "ds": days.date, "y": np.asarray(values, float)})


def broken(n=900, at=400, noise=0.0, seed=1):
    t = np.arange(n)
    return 100 + 0.5 * t - 0.9 * np.maximum(0, t - at) + np.random.default_rng(seed).normal(0, noise, n) if noise else 100 + 0.5 * t - 0.9 * np.maximum(0, t - at)


def changes(values):
    days = np.arange(len(values), dtype=float)
    cps, beta, sd = forecast.fit(days, values / np.abs(values).max(), days.max())
    return cps * days.max(), beta[2 : 2 + len(cps)], sd


def test_one_break_gives_few_changes_near_it():
    at, found, _ = changes(broken(noise=6.0))
    large = np.abs(found) > 0.05 * np.abs(found).max()
    assert 1 <= large.sum() <= 4 and (found == 0).sum() >= len(found) // 2
    assert abs(np.average(at[large], weights=np.abs(found[large])) - 400) < 60


def test_a_straight_line_has_no_change_and_a_flat_band():
    values = 50 + 0.3 * np.arange(700) + np.random.default_rng(2).normal(0, 5, 700)
    _, found, _ = changes(values)
    assert np.abs(found).max() < 0.05
    out = forecast.fit_predict(series(values), 60)
    width = (out.yhat_upper - out.yhat_lower).to_numpy()
    assert width[30:].mean() < 1.3 * width[:30].mean()
    assert np.abs(out.yhat - (50 + 0.3 * np.arange(700, 760))).max() < 6


def test_a_series_without_noise_is_continued():
    values = broken()
    out = forecast.fit_predict(series(values), 30, history=True)
    past, future = out[~out.is_future], out[out.is_future]
    assert np.abs(past.yhat - values).max() < 0.03 * np.abs(values).max()
    assert np.abs(future.yhat.to_numpy() - (100 + 0.5 * np.arange(900, 930) - 0.9 * np.arange(500, 530))).max() < 0.05 * np.abs(values).max()


def test_the_band_widens_where_the_trend_has_changed():
    out = forecast.fit_predict(series(broken(noise=4.0)), 200)
    width = (out.yhat_upper - out.yhat_lower).to_numpy()
    assert width[-20:].mean() > 1.5 * width[:20].mean()
    assert ((out.yhat_lower <= out.yhat) & (out.yhat <= out.yhat_upper)).all()


def test_draws_are_seeded_by_the_series():
    one = forecast.fit_predict(series(broken(noise=4.0)), 50)
    pd.testing.assert_frame_equal(one, forecast.fit_predict(series(broken(noise=4.0)).sample(frac=1, random_state=3), 50))
    other = forecast.fit_predict(series(broken(noise=4.0), "x"), 50)
    assert (other.yhat_upper != one.yhat_upper).any() and (other.yhat == one.yhat).all()


def test_held_out_days_fall_into_the_band():
    rng, inside, total = np.random.default_rng(5), 0, 0
    for k in range(8):
        t = np.arange(830)
        values = 200 + 0.1 * t + 20 * np.sin(2 * np.pi * t / 7) + 30 * np.sin(2 * np.pi * t / 365.25) + rng.normal(0, 12, 830)
        out = forecast.fit_predict(series(values[:800], str(k)), 30)
        inside += ((values[800:] >= out.yhat_lower) & (values[800:] <= out.yhat_upper)).sum()
        total += 30
    assert 0.65 <= inside / total <= 0.95


@pytest.mark.parametrize("n", [1, 2, 5, 13, 60])
def test_short_histories_have_all_rows(n):
    out = forecast.fit_predict(series([100.0 + i for i in range(n)]), 7, history=True)
    assert len(out) == n + 7 and out.is_future.sum() == 7 and out.yhat.notna().all()


def test_constant_and_zero_series():
    for value in (0.0, 12.5):
        out = forecast.fit_predict(series([value] * 200), 10, history=True)
        assert np.allclose(out.yhat, value, atol=1e-2) and np.allclose(out.yhat_upper - out.yhat_lower, 0, atol=1e-2)


def test_history_and_future_rows_of_every_category(spark):
    c = catalog.clean(spark, SF_SMALL)
    out = forecast.prediction(c, 15, by="category")
    d = c.where("order_status = 'Delivered'")
    assert out.where("is_future").groupBy("series").count().where("count <> 15").count() == 0
    past = out.where(~F.col("is_future"))
    assert past.count() == d.select("category", "sale_date").distinct().count()
    assert abs(past.agg(F.sum("y")).first()[0] - float(d.agg(F.sum("total_amount")).first()[0])) < 0.01
    assert out.where("is_future and y is not null or not is_future and y is null").count() == 0
    assert isinstance(past.first()["ds"], dt.date)
