"""Seasonal per-category forecast with grouped pandas functions (U1, D1(b), D2(b)).

The weekly series is built and gap-filled in Spark (:func:`forecast.weekly_series`),
so each group handed to pandas is one category's weeks -- bounded by the
calendar, not by the number of orders. Inside the group: ridge regression on
an intercept, a linear trend and yearly Fourier terms, solved with numpy.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake import schemas
from storelake.config import (FORECAST_HORIZON_WEEKS, FORECAST_MIN_DAYS,
                              FORECAST_MIN_TRAIN_WEEKS, FORECAST_TEST_WEEKS)
from storelake.operators.forecast import Z80, weekly_series

WEEKS_PER_YEAR = 365.25 / 7
FOURIER_ORDER = 3
RIDGE = 1e-3


def _design(x: np.ndarray, order: int) -> np.ndarray:
    cols = [np.ones_like(x, dtype=float), x.astype(float)]
    for k in range(1, order + 1):
        a = 2 * np.pi * k * x / WEEKS_PER_YEAR
        cols += [np.sin(a), np.cos(a)]
    return np.column_stack(cols)


def fit_predict(x_train: np.ndarray, y_train: np.ndarray, x_out: np.ndarray, order: int):
    """Ridge fit on the training weeks; predictions and residual sigma. ``order``
    yearly Fourier terms whatever the length: the penalty tames short series."""
    X = _design(x_train, order)
    pen = RIDGE * len(x_train) * np.eye(X.shape[1])
    pen[0, 0] = 0.0                                   # the intercept is not shrunk
    beta = np.linalg.solve(X.T @ X + pen, X.T @ y_train)
    resid = y_train - X @ beta
    dof = max(len(x_train) - X.shape[1], 1)
    sigma = float(np.sqrt(resid @ resid / dof))
    return _design(x_out, order) @ beta, sigma


def _forecast_group(pdf: pd.DataFrame, order: int) -> pd.DataFrame:
    pdf = pdf.sort_values("x")
    cat = pdf["category_english"].iloc[0]
    x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy(dtype=float)
    last = pd.Timestamp(pdf["week"].iloc[-1])
    xf = np.arange(x[-1] + 1, x[-1] + 1 + FORECAST_HORIZON_WEEKS)
    yhat, sigma = fit_predict(x, y, np.concatenate([x, xf]), order)
    ds = list(pd.to_datetime(pdf["week"])) + [last + pd.Timedelta(weeks=i + 1) for i in range(len(xf))]
    return pd.DataFrame({"category_english": cat, "ds": ds, "yhat": yhat,
                         "yhat_lower": yhat - Z80 * sigma, "yhat_upper": yhat + Z80 * sigma})


def _evaluate_group(pdf: pd.DataFrame, order: int) -> pd.DataFrame:
    pdf = pdf.sort_values("x")
    train, test = pdf.iloc[:-FORECAST_TEST_WEEKS], pdf.iloc[-FORECAST_TEST_WEEKS:]
    pred, _ = fit_predict(train["x"].to_numpy(), train["y"].to_numpy(dtype=float), test["x"].to_numpy(), order)
    e = pred - test["y"].to_numpy(dtype=float)
    return pd.DataFrame([{"category_english": pdf["category_english"].iloc[0],
                          "test_points": len(test), "mae": float(np.mean(np.abs(e))),
                          "rmse": float(np.sqrt(np.mean(e * e)))}])


def seasonal_forecast(daily_sales: DataFrame, min_days: int = FORECAST_MIN_DAYS,
                      fourier_order: int = FOURIER_ORDER) -> DataFrame:
    """History plus 12 future weeks per category (categories with >= 30 sale days)."""
    s = weekly_series(daily_sales).filter(F.col("n_days") >= min_days)
    return (s.select("category_english", "week", "x", "y").groupBy("category_english")
            .applyInPandas(lambda g: _forecast_group(g, fourier_order), schema=schemas.FORECAST))


def seasonal_backtest(daily_sales: DataFrame, fourier_order: int = FOURIER_ORDER) -> DataFrame:
    """Last 8 weeks held out, per category with at least 23 weeks."""
    s = weekly_series(daily_sales).filter(
        F.col("n") >= FORECAST_TEST_WEEKS + FORECAST_MIN_TRAIN_WEEKS)
    return (s.select("category_english", "week", "x", "y").groupBy("category_english")
            .applyInPandas(lambda g: _evaluate_group(g, fourier_order), schema=schemas.FORECAST_EVAL))
