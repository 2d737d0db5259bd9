"""Daily revenue forecast.

The reference fits Prophet to one daily series. Prophet is not available
here, so the model is re-aimed at the published structure of that method:
a piecewise-linear trend with changepoints in the first 80% of the history,
yearly Fourier order 10, weekly Fourier order 3, an 80% interval. Numeric
equality with Prophet is not claimed.

*Fit.* Changes of slope have a Laplace prior, so the fit is sparse (L1) in
them: the ridge terms (level, slope, seasons) are eliminated, and coordinate
descent solves what is left, a lasso over the changepoints. Noise and penalty
are set in turn, as the penalty is noise variance over prior scale.

*Band.* Future changes of slope are simulated, with the frequency and mean
size of those fitted, and noise is added; the band is the middle 80% of the
simulated paths, so it widens with the horizon where the trend has changed
before. The draws are seeded by the series' name. Fitted days have the band
of the noise.

Spark does the distributed part: the daily roll-up (F1) over all sales and
one independent fit per series via ``groupBy(series).applyInPandas``, so a
forecast per category, region or product runs in parallel across
executors. Each group holds one series' daily points, which the calendar
bounds (a few thousand days), not the number of sales.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.operators.common import delivered, non_null_key, sum_d
from ledgerlens.session import ship_package

# Fixed model settings (the reference's requested Prophet options and the
# method's published defaults).
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
YEARLY_ORDER = 10
WEEKLY_ORDER = 3
YEAR_DAYS = 365.25
INTERVAL_Z = 1.2815515655446004  # 80% two-sided normal interval
CHANGEPOINT_PRIOR = 0.05
SEASONALITY_PRIOR = 10.0
# Small ridge on intercept and slope, so that a series of any length (one point too) has one solution.
TREND_RIDGE = 1e-9

# Simulated paths of a band, and the steps that fit the noise.
PATHS, PATH_BLOCK = 1000, 100
NOISE_ROUNDS, SWEEPS, STEP_TOLERANCE = 8, 2000, 1e-9
# Priors count at least this noise (share of the largest value), so that series without any have one solution.
LEAST_NOISE = 0.01

FORECAST_SCHEMA = "series string, ds date, is_future boolean, y double, yhat double, yhat_lower double, yhat_upper double"


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    cols = []
    for k in range(1, order + 1):
        a = 2.0 * np.pi * k * days / period
        cols += [np.sin(a), np.cos(a)]
    return np.column_stack(cols) if cols else np.empty((len(days), 0))


def _design(days: np.ndarray, t0: float, span: float, cps: np.ndarray) -> np.ndarray:
    t = (days - t0) / span
    hinges = np.maximum(0.0, t[:, None] - cps[None, :]) if len(cps) else np.empty((len(t), 0))
    return np.column_stack([np.ones_like(t), t, hinges, _fourier(days, YEAR_DAYS, YEARLY_ORDER), _fourier(days, 7.0, WEEKLY_ORDER)])


def sparse_changes(gram: np.ndarray, target: np.ndarray, penalty: float, start: np.ndarray, least: np.ndarray) -> np.ndarray:
    """argmin of x'Gx/2 - t'x + penalty * |x|_1 by coordinate descent from ``start``; a diagonal below ``least`` leaves x at 0."""
    size = np.diag(gram)
    free = np.flatnonzero(size > least)
    x = np.where(size > least, start, 0.0)
    for _ in range(SWEEPS):
        largest = 0.0
        for j in free:
            pull = target[j] - gram[j] @ x + size[j] * x[j]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / size[j]
            largest = max(largest, abs(new - x[j]))
            x[j] = new
        if largest < STEP_TOLERANCE:
            break
    return x


def fit(days: np.ndarray, ys: np.ndarray, span: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Changepoints, coefficients of the design and standard deviation of the noise, for scaled values."""
    n_hist = int(np.floor(len(days) * CHANGEPOINT_RANGE))
    idx = np.unique(np.linspace(0, max(n_hist - 1, 0), N_CHANGEPOINTS + 1).round().astype(int))[1:]
    cps = days[idx] / span
    X = _design(days, 0.0, span, cps)
    hinge = np.zeros(X.shape[1], bool)
    hinge[2 : 2 + len(cps)] = True
    H, Z = X[:, hinge], X[:, ~hinge]
    beta, sd = np.zeros(X.shape[1]), float(np.std(ys))
    for _ in range(NOISE_ROUNDS):
        # ridge terms by their normal prior, in units of the noise
        noise = max(sd, LEAST_NOISE) ** 2
        ridge = np.full(Z.shape[1], noise / SEASONALITY_PRIOR**2)
        ridge[:2] = TREND_RIDGE
        inverse = np.linalg.inv(Z.T @ Z + np.diag(ridge))
        rest = inverse @ (Z.T @ H)
        base = inverse @ (Z.T @ ys)
        gram = H.T @ H - (H.T @ Z) @ rest
        target = H.T @ ys - (H.T @ Z) @ base
        # a hinge that the other terms all but express is left out
        changes = sparse_changes(gram, target, noise / CHANGEPOINT_PRIOR, beta[hinge], 1e-6 * np.sum(H * H, axis=0))
        beta[hinge], beta[~hinge] = changes, base - rest @ changes
        new = float(np.std(ys - X @ beta))
        done, sd = abs(new - sd) <= 1e-4 * sd, new
        if done:
            break
    return cps, beta, sd


def simulated_band(changes: np.ndarray, sd: float, n_days: float, horizon: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper deviation of each future day from the trend that goes on unchanged.

    A future day changes the slope as often as a day of the history had a
    changepoint, by a Laplace draw of the fitted changes' mean size.
    """
    rng = np.random.default_rng(seed)
    chance = min(1.0, len(changes) / max(n_days, 1.0))
    size = float(np.mean(np.abs(changes))) if len(changes) else 0.0
    paths = []
    for _ in range(0, PATHS, PATH_BLOCK):
        turned = rng.random((PATH_BLOCK, horizon)) < chance
        slope = np.cumsum(np.where(turned, rng.laplace(0.0, size, (PATH_BLOCK, horizon)) if size else 0.0, 0.0), axis=1)
        paths.append(np.cumsum(slope / max(n_days, 1.0), axis=1) + rng.normal(0.0, sd, (PATH_BLOCK, horizon)))
    low, high = np.quantile(np.concatenate(paths), [0.1, 0.9], axis=0)
    return np.minimum(low, 0.0), np.maximum(high, 0.0)


def fit_predict(pdf: pd.DataFrame, horizon: int, history: bool = False) -> pd.DataFrame:
    """Fit one series (columns series, ds, y) and return its ``horizon`` future days, after its own days with ``history``."""
    pdf = pdf.sort_values("ds")
    series = pdf["series"].iloc[0]
    ds = pd.to_datetime(pdf["ds"]).to_numpy()
    y = pdf["y"].astype(float).to_numpy()
    days = (ds - ds.min()).astype("timedelta64[D]").astype(float)
    fut = pd.date_range(pd.Timestamp(ds.max()) + pd.Timedelta(days=1), periods=horizon, freq="D")
    fut_days = (fut.to_numpy() - ds.min()).astype("timedelta64[D]").astype(float)
    span = max(days.max(), 1.0)
    scale = float(np.max(np.abs(y))) or 1.0
    cps, beta, sd = fit(days, y / scale, span)
    low, high = simulated_band(beta[2 : 2 + len(cps)], sd, span, horizon, zlib.crc32(str(series).encode()))
    yhat = _design(fut_days, 0.0, span, cps) @ beta
    future = pd.DataFrame({"ds": fut.date, "is_future": True, "y": np.nan, "yhat": yhat, "yhat_lower": yhat + low, "yhat_upper": yhat + high})
    if history:
        fitted, width = _design(days, 0.0, span, cps) @ beta, INTERVAL_Z * sd
        past = pd.DataFrame({"ds": pd.to_datetime(pdf["ds"]).dt.date.to_numpy(), "is_future": False, "y": y, "yhat": fitted, "yhat_lower": fitted - width, "yhat_upper": fitted + width})
        future = pd.concat([past, future], ignore_index=True)
    scaled = future.assign(series=series, **{c: future[c] * scale for c in ("yhat", "yhat_lower", "yhat_upper")})
    return scaled[["series", "ds", "is_future", "y", "yhat", "yhat_lower", "yhat_upper"]]


def daily_series(clean: DataFrame, by: str | None = None) -> DataFrame:
    """F1 generalised: (series, ds, y) for the total (``by=None``) or one series per ``by`` value."""
    d = non_null_key(delivered(clean), "sale_date", *([by] if by else []))
    key = F.col(by).cast("string") if by else F.lit("ALL")
    return d.groupBy(key.alias("series"), F.col("sale_date").alias("ds")).agg(sum_d("total_amount").alias("y"))


def prediction(clean: DataFrame, days: int = S.FORECAST_DAYS, by: str | None = None, history: bool = True) -> DataFrame:
    """F2 + F3: series, ds, is_future, y (NULL in the future), yhat and band of the days that have sales and the ``days`` after them."""
    ship_package(clean.sparkSession)  # fit_predict runs in the Python workers
    series = daily_series(clean, by)
    out = series.groupBy("series").applyInPandas(lambda pdf: fit_predict(pdf, days, history), schema=FORECAST_SCHEMA)
    return out.withColumns({c: F.bround(c, 2) for c in ("yhat", "yhat_lower", "yhat_upper")}).withColumn("y", F.when(~F.col("is_future"), F.col("y")))


def forecast(clean: DataFrame, days: int = S.FORECAST_DAYS, by: str | None = None) -> DataFrame:
    """F2 + F4: future rows only, values rounded to 2."""
    return prediction(clean, days, by, history=False).drop("is_future", "y")


def forecast_summary(fc: DataFrame) -> DataFrame:
    """per series, total and mean predicted revenue and the peak day (earliest on ties)."""
    return fc.groupBy("series").agg(
        F.bround(F.sum("yhat"), 2).alias("total_predicted"),
        F.bround(F.avg("yhat"), 2).alias("avg_daily"),
        F.min_by("ds", F.struct((-F.col("yhat")).alias("v"), F.col("ds").alias("d"))).alias("peak_day"),
        F.count(F.lit(1)).alias("days"),
    )
