"""Sparse trend changes, intervals and back-tests of the demand forecast."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from mercato.plans.forecast import _columns, _descend, backtest, coverage, demand_forecast, fit, fit_predict


def _series(months, seed, change_at=None, noise=0.01, region="R"):
    ds = pd.date_range("1992-01-01", periods=months, freq="MS")
    t = np.arange(months) / months
    y = 100 + 20 * t + 5 * np.sin(2 * np.pi * np.arange(months) / 12)
    if change_at is not None:
        y = y + 150 * np.maximum(0, t - change_at)
    y = y + np.random.default_rng(seed).standard_normal(months) * noise * 100
    return pd.DataFrame({"region": region, "ds": ds.date, "y": y})


def _days(pdf):
    d = pd.to_datetime(pdf["ds"])
    return (d - d.iloc[0]).dt.days.to_numpy(float)


@pytest.mark.parametrize("at", [0.3, 0.5, 0.7])
def test_planted_change_is_found(at):
    pdf = _series(84, 1, at)
    model = fit(_days(pdf), pdf["y"].to_numpy())
    found = np.flatnonzero(np.abs(model.slopes) > 0.05 * np.abs(model.slopes).max())
    assert len(found) <= 6  # sparse
    weight = np.abs(model.slopes)
    assert abs((weight * model.changes).sum() / weight.sum() - at) < 0.06


def test_no_change_gives_a_straight_trend():
    pdf = _series(84, 2)
    model = fit(_days(pdf), pdf["y"].to_numpy())
    assert np.abs(model.slopes).sum() * model.scale < 12


def test_descent_meets_the_optimality_conditions():
    pdf = _series(60, 3, 0.4)
    x = _columns(_days(pdf), _days(pdf)[-1], np.linspace(0, 0.8, 8)[1:-1])
    y = pdf["y"].to_numpy() / 200
    lasso = np.r_[0, 0, np.full(6, 0.02), np.zeros(12)]
    ridge = np.r_[np.zeros(8), np.full(12, 0.01)]
    b = _descend(x.T @ x, x.T @ y, np.zeros(20), lasso, ridge, 20_000)
    slope = x.T @ (y - x @ b) - ridge * b
    for j in range(20):
        if b[j] != 0:
            assert slope[j] == pytest.approx(lasso[j] * np.sign(b[j]), abs=1e-4)
        else:
            assert abs(slope[j]) <= lasso[j] + 1e-4


def test_interval_covers_about_what_it_states():
    inside = []
    for seed in range(40):
        pdf = _series(84, seed, noise=0.03, region=f"r{seed}")
        made = fit_predict(pdf.iloc[:72], 12)
        made = made[made["is_forecast"] == "forecast"]
        inside += list((pdf["y"].to_numpy()[72:] >= made["yhat_lower"]) & (pdf["y"].to_numpy()[72:] <= made["yhat_upper"]))
    assert 0.70 <= np.mean(inside) <= 0.92


def test_forecast_and_backtest_on_spark(spark):
    rows = pd.concat([_series(72, 5, region="A"), _series(72, 6, 0.5, region="B"), _series(5, 7, region="short")])
    rows.loc[rows.index[3], "y"] = np.nan
    df = spark.createDataFrame(rows, "region string, ds date, y double").withColumn("y", F.nanvl("y", F.lit(None)))
    made = demand_forecast(df).toPandas()
    assert made.groupby("region").size().to_dict() == {"A": 78, "B": 78, "short": 11}
    assert made["yhat"].notna().all() and (made["yhat_lower"] <= made["yhat_upper"]).all()
    again = demand_forecast(df.repartition(7)).toPandas()
    keys = ["region", "ds"]
    pd.testing.assert_frame_equal(made.sort_values(keys, ignore_index=True), again.sort_values(keys, ignore_index=True))
    tested = backtest(df).toPandas()
    assert set(tested["region"]) == {"A", "B"} and tested.groupby(["region", "fold"]).size().eq(6).all()
    assert tested["fold"].nunique() == 6
    assert {r.region: r.months for r in coverage(backtest(df)).collect()} == {"A": 36, "B": 36}
