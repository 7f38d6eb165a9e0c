"""Demand forecast per region: sparse trend changes, yearly season, simulated intervals.

An additive model on monthly values: a line whose slope may change at candidate dates over
the first 80 % of the history, and Fourier terms of the year.  Slope changes carry an
absolute-value penalty (a Laplace prior), so most come out as exactly zero; they are found
by coordinate descent, in turn with the noise level.  The interval is read off simulated
futures: drawn coefficients, slope changes that go on as often and as large as in the
history, and noise.  Draws are seeded by a checksum of the region's name, so a retried task
gives the same rows.

A series is bounded by the calendar; regions, and folds of the back-test, are groups on the
executors.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.numeric import round_half_up

SCHEMA = ("region string, ds date, y double, yhat double, yhat_lower double, yhat_upper double, "
          "is_forecast string")
CANDIDATES = 25      # dates at which the slope may change
HISTORY_SHARE = 0.8  # of the history, from its start, has candidates
FOURIER = 6
CHANGE_SCALE = 0.05  # of the Laplace prior, in units of the largest value over the whole history
SEASON_SCALE = 10.0
DRAWS = 1000
COVERAGE = 0.8


@dataclass
class Fit:
    beta: np.ndarray
    sigma: float
    covariance: np.ndarray  # of the coefficients that are not zero
    active: np.ndarray
    changes: np.ndarray     # candidate times
    scale: float
    span: float             # days of the history
    orders: int             # Fourier terms

    @property
    def slopes(self) -> np.ndarray:
        return self.beta[2:2 + len(self.changes)]


def _columns(days: np.ndarray, span: float, changes: np.ndarray, orders: int = FOURIER) -> np.ndarray:
    t = days / span
    out = [np.ones_like(t), t, *[np.maximum(0.0, t - c) for c in changes]]
    for k in range(1, orders + 1):
        turn = 2 * np.pi * k * days / 365.25
        out += [np.sin(turn), np.cos(turn)]
    return np.column_stack(out)


def _descend(gram: np.ndarray, xy: np.ndarray, beta: np.ndarray, lasso: np.ndarray, ridge: np.ndarray,
             sweeps: int = 500) -> np.ndarray:
    """Coordinate descent on 1/2 |y - Xb|^2 + sum lasso |b| + 1/2 sum ridge b^2."""
    beta = beta.copy()
    steps = np.diag(gram) + ridge
    for _ in range(sweeps):
        moved = 0.0
        for j in np.flatnonzero(steps > 0):
            rest = xy[j] - gram[j] @ beta + gram[j, j] * beta[j]
            new = np.sign(rest) * max(abs(rest) - lasso[j], 0.0) / steps[j]
            moved = max(moved, abs(new - beta[j]))
            beta[j] = new
        if moved < 1e-9:
            break
    return beta


def fit(days: np.ndarray, y: np.ndarray) -> Fit:
    """``days`` since the first row, ascending; ``y`` without nulls."""
    n, span = len(y), max(float(days[-1]), 1.0)
    scale = max(float(np.abs(y).max()), 1e-9)
    ys = y / scale
    inner = np.linspace(0, HISTORY_SHARE, CANDIDATES + 2)[1:-1] if n > 3 else np.array([])
    orders = min(FOURIER, n // 4)  # a short history does not carry a whole season
    x = _columns(days, span, inner, orders)
    season = np.r_[np.zeros(2 + len(inner)), np.ones(2 * orders)]
    change = np.r_[np.zeros(2), np.ones(len(inner)), np.zeros(2 * orders)]
    gram, xy = x.T @ x, x.T @ ys
    sigma = max(float(np.std(ys)) / 2, 1e-6)
    beta = np.linalg.lstsq(x[:, :2], ys, rcond=None)[0]
    beta = np.r_[beta, np.zeros(x.shape[1] - 2)]
    for _ in range(10):
        beta = _descend(gram, xy, beta, change * sigma ** 2 / CHANGE_SCALE, season * (sigma / SEASON_SCALE) ** 2)
        used = np.count_nonzero(beta)
        new = max(float(np.sqrt(np.sum((ys - x @ beta) ** 2) / max(n - used, 1))), 1e-6)
        done = abs(new - sigma) < 1e-4 * sigma
        sigma = new
        if done:
            break
    active = np.flatnonzero(beta)
    inside = gram[np.ix_(active, active)] + np.diag((season * (sigma / SEASON_SCALE) ** 2)[active] + 1e-9)
    return Fit(beta, sigma, sigma ** 2 * np.linalg.inv(inside), active, inner, scale, span, orders)


def simulate(model: Fit, days: np.ndarray, seed: int) -> np.ndarray:
    """(draws, days): futures by drawn coefficients, later slope changes and noise."""
    rng = np.random.default_rng(seed)
    x = _columns(days, model.span, model.changes, model.orders)
    sizes, axes = np.linalg.eigh(model.covariance)
    spread = axes * np.sqrt(np.maximum(sizes, 0.0))
    drawn = model.beta[model.active] + rng.standard_normal((DRAWS, len(model.active))) @ spread.T
    out = drawn @ x[:, model.active].T
    t, end = days / model.span, max(float(days.max()) / model.span, 1.0)
    rate = len(model.changes) / HISTORY_SHARE * (end - 1.0)
    size = float(np.abs(model.slopes).mean()) if len(model.slopes) else 0.0
    if rate > 0 and size > 0:
        counts = rng.poisson(rate, DRAWS)
        owner = np.repeat(np.arange(DRAWS), counts)
        when = rng.uniform(1.0, end, counts.sum())
        slope = rng.laplace(0.0, size, counts.sum())
        np.add.at(out, owner, slope[:, None] * np.maximum(0.0, t[None, :] - when[:, None]))
    return (out + rng.standard_normal(out.shape) * model.sigma) * model.scale


def fit_predict(pdf: pd.DataFrame, horizon: int = 6, seed_text: str = "") -> pd.DataFrame:
    """History and ``horizon`` further months of one region; months without a value are not fitted."""
    pdf = pdf.sort_values("ds")
    region = pdf["region"].iloc[0]
    ds = pd.to_datetime(pdf["ds"])
    y = pdf["y"].astype(float).to_numpy()
    coming = pd.date_range(ds.iloc[-1] + pd.offsets.MonthBegin(1), periods=horizon, freq="MS")
    dates = pd.DatetimeIndex([*ds, *coming])
    out = pd.DataFrame({"region": region, "ds": dates.date, "y": [*y, *[np.nan] * horizon]})
    known = np.flatnonzero(~np.isnan(y))
    if known.size:
        days = (dates - dates[known[0]]).days.to_numpy(dtype=float)
        model = fit(days[known], y[known])
        draws = simulate(model, days, zlib.crc32(f"{region}{seed_text}".encode()))
        out["yhat"] = _columns(days, model.span, model.changes, model.orders) @ model.beta * model.scale
        out["yhat_lower"], out["yhat_upper"] = np.quantile(draws, [(1 - COVERAGE) / 2, (1 + COVERAGE) / 2], axis=0)
    else:
        out["yhat"] = out["yhat_lower"] = out["yhat_upper"] = np.nan
    out["is_forecast"] = ["actual"] * len(y) + ["forecast"] * horizon
    return out


def _values(series: DataFrame) -> DataFrame:
    return series.select("region", "ds", F.col("y").cast("double").alias("y")).where(F.col("ds").isNotNull())


def demand_forecast(series: DataFrame, horizon: int = 6) -> DataFrame:
    """gold_demand_forecast: one model per region, fitted on the executors."""
    return _values(series).groupBy("region").applyInPandas(lambda p: fit_predict(p, horizon), SCHEMA)


def backtest(series: DataFrame, horizon: int = 6, folds: int = 6) -> DataFrame:
    """Forecasts of months that the fit did not see: fold f leaves out the last f + ``horizon`` - 1 months.

    One row per region, fold and held-out month; regions need three years before them.
    """
    last = F.add_months(F.max("ds"), 0)
    ends = _values(series).groupBy("region").agg(last.alias("_last"), F.min("ds").alias("_first"))
    cuts = ends.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds)))) \
        .withColumn("_cut", F.add_months("_last", -(F.col("fold") + F.lit(horizon - 1)))) \
        .where(F.months_between("_cut", "_first") >= 35).select("region", "fold", "_cut")
    rows = _values(series).join(cuts, "region").where(F.col("ds") <= F.add_months("_cut", horizon))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        fold, cut = int(pdf["fold"].iloc[0]), pdf["_cut"].iloc[0]
        known = pdf[pdf["ds"] <= cut]
        made = fit_predict(known[["region", "ds", "y"]], horizon, f"/{fold}")
        made = made[made["is_forecast"] == "forecast"].drop(columns="y").merge(pdf[["ds", "y"]], on="ds")
        return made.assign(fold=fold)[["region", "fold", "ds", "y", "yhat", "yhat_lower", "yhat_upper"]]

    return rows.groupBy("region", "fold").applyInPandas(
        one, "region string, fold int, ds date, y double, yhat double, yhat_lower double, yhat_upper double")


def coverage(tested: DataFrame) -> DataFrame:
    """Per region: held-out months, share inside the interval, mean absolute percentage error."""
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    error = F.abs(F.col("y") - F.col("yhat")) / F.nullif(F.abs(F.col("y")), F.lit(0.0))
    return tested.groupBy("region").agg(F.count("y").alias("months"), round_half_up(F.avg(inside.cast("int")), 4).alias("covered"),
                                        round_half_up(F.avg(error) * F.lit(100.0), 4).alias("mape_pct"))
