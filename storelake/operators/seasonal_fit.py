"""The seasonal forecast fitted without Python (D1, D2): normal equations per category from aggregated sums.

The model is that of :mod:`storelake.operators.seasonal`: an intercept, a linear trend and yearly Fourier terms with a
ridge penalty. The products of the terms are summed per category as decimals -- partial sums per task, the
same total in whatever order they meet -- and the few sums of a category, eight by nine, are solved by
Gauss-Jordan elimination over arrays in one expression. Nothing of a category is collected but these sums, so it doesn't matter how many
weeks, or categories, there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.config import (FORECAST_HORIZON_WEEKS, FORECAST_MIN_DAYS,
                              FORECAST_MIN_TRAIN_WEEKS, FORECAST_TEST_WEEKS)
from storelake.operators.forecast import CAT, Z80, weekly_series
from storelake.operators.seasonal import FOURIER_ORDER, RIDGE, WEEKS_PER_YEAR

SUM = "decimal(38,12)"
SQUARES = "decimal(38,9)"


def terms(x: Column, order: int = FOURIER_ORDER) -> list[Column]:
    """Intercept, trend in years, and the Fourier pairs, at week ``x``."""
    x = x.cast("double")
    out = [F.lit(1.0), x / F.lit(WEEKS_PER_YEAR)]
    for k in range(1, order + 1):
        a = x * F.lit(2 * math.pi * k / WEEKS_PER_YEAR)
        out += [F.sin(a), F.cos(a)]
    return out


def solve(matrix: Column, size: int) -> Column:
    """The solution of a symmetric positive definite system, given as rows with the right-hand side last."""
    def eliminate(m, k):
        pivot = F.get(m, k)
        return F.transform(m, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / F.get(pivot, k))).otherwise(
            F.transform(row, lambda v, j: v - F.get(row, k) / F.get(pivot, k) * F.get(pivot, j))))

    reduced = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, eliminate)
    return F.transform(reduced, lambda row: F.get(row, F.lit(size)))


def fit_seasonal(series: DataFrame, order: int = FOURIER_ORDER, ridge: float = RIDGE) -> DataFrame:
    """(category, m, beta, last_week, last_x) of weekly series: ``beta`` holds a coefficient per term."""
    t = terms(F.col("x"), order)
    d = len(t)
    y = F.col("y").cast("double")
    sums = {f"s_{i}_{j}": F.sum((t[i] * (t[j] if j < d else y)).cast(SUM)) for i in range(d) for j in range(i, d + 1)}
    agg = series.groupBy(CAT).agg(F.count(F.lit(1)).alias("m"), F.max("week").alias("last_week"), F.max("x").alias("last_x"),
                                  *[c.alias(n) for n, c in sums.items()])
    # the penalty of the trend is that of a trend in weeks
    penalty = [0.0, ridge / WEEKS_PER_YEAR**2, *[ridge] * (d - 2)]

    def entry(i, j):
        s = F.col(f"s_{min(i, j)}_{max(i, j)}").cast("double")
        return s + F.lit(penalty[i]) * F.col("m") if i == j else s

    matrix = F.array(*[F.array(*[entry(i, j) for j in range(d + 1)]) for i in range(d)])
    return agg.select(CAT, "m", "last_week", "last_x", solve(matrix, d).alias("beta"))


def _predict(x: Column, order: int) -> Column:
    out = F.lit(0.0)
    for k, t in enumerate(terms(x, order)):
        out = out + F.get("beta", F.lit(k)) * t
    return out


def seasonal_forecast(daily_sales: DataFrame, horizon: int = FORECAST_HORIZON_WEEKS, min_days: int = FORECAST_MIN_DAYS,
                      order: int = FOURIER_ORDER) -> DataFrame:
    """History plus ``horizon`` future weeks per category with an 80 % band (categories with >= ``min_days`` sale days)."""
    s = weekly_series(daily_sales).filter(F.col("n_days") >= min_days)
    fit = fit_seasonal(s, order)
    r = F.col("y").cast("double") - _predict(F.col("x"), order)
    sigma = (s.join(fit, CAT).groupBy(CAT).agg(F.sum((r * r).cast(SQUARES)).cast("double").alias("rss"), F.max("m").alias("m"))
             .select(CAT, F.sqrt(F.col("rss") / F.greatest(F.col("m") - (2 * order + 2), F.lit(1))).alias("sigma")))
    weeks = s.select(CAT, "week", "x").unionByName(
        fit.select(CAT, "last_week", "last_x", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i"))
           .select(CAT, F.date_add("last_week", F.col("i") * 7).alias("week"), (F.col("last_x") + F.col("i")).alias("x")))
    band = F.lit(Z80) * F.col("sigma")
    return (weeks.join(fit.select(CAT, "beta"), CAT).join(sigma, CAT)
            .select(CAT, F.col("week").cast("timestamp_ntz").alias("ds"), _predict(F.col("x"), order).alias("yhat"), band.alias("band"))
            .select(CAT, "ds", "yhat", (F.col("yhat") - F.col("band")).alias("yhat_lower"), (F.col("yhat") + F.col("band")).alias("yhat_upper")))


def seasonal_backtest(daily_sales: DataFrame, test_weeks: int = FORECAST_TEST_WEEKS,
                      min_train_weeks: int = FORECAST_MIN_TRAIN_WEEKS, order: int = FOURIER_ORDER) -> DataFrame:
    """Last ``test_weeks`` weeks held out, per category with enough weeks: test_points, mae, rmse."""
    s = weekly_series(daily_sales).filter(F.col("n") >= test_weeks + min_train_weeks)
    is_test = F.col("x") >= F.col("n") - test_weeks
    fit = fit_seasonal(s.filter(~is_test), order)
    e = _predict(F.col("x"), order) - F.col("y").cast("double")
    return (s.filter(is_test).join(fit, CAT).select(CAT, e.alias("e")).groupBy(CAT)
            .agg(F.count(F.lit(1)).alias("test_points"), F.avg(F.abs("e")).alias("mae"),
                 F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse")))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` decimals: what two ways to the same fit agree on."""
    return df.select([F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
