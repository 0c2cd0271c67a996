"""Weekly demand per category: gap-filled series, trend backtest, forecast
(A5, A6, D1-D4, A8, O2).

The forecasting library the source project calls per category is not
available here; the model is a least-squares linear trend over the weekly
series, fitted with plain aggregates (no per-group Python), with an 80 %
band from the residual standard error. Everything is grouped by category,
and every per-category collection is bounded by the number of weeks in the
series (a calendar bound), never by the number of orders.

Sums that decide a reported number (residuals, errors) are folded over a
sorted array, so the result does not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.config import (FORECAST_HORIZON_WEEKS, FORECAST_MIN_DAYS,
                              FORECAST_MIN_TRAIN_WEEKS, FORECAST_TEST_WEEKS)
from storelake.functions.dates import week_ending_sunday

CAT = "category_english"
Z80 = 1.2815515655446004   # two-sided 80 % normal quantile


def _ordered_sum(values: Column) -> Column:
    """Sum of a collected list, in ascending order (deterministic)."""
    return F.aggregate(F.array_sort(values), F.lit(0.0), lambda acc, v: acc + v)


def daily_series(daily_sales: DataFrame) -> DataFrame:
    """(category, day, y): complete rows only, re-summed per day (S3, A5)."""
    return (daily_sales.select("sale_date", CAT, "num_orders").na.drop()
            .groupBy(CAT, "sale_date").agg(F.sum("num_orders").alias("y")))


def weekly_series(daily_sales: DataFrame) -> DataFrame:
    """Weeks ending Sunday, every week between a category's first and last
    one present, empty weeks 0 (A6). ``x`` is the week index from 0, ``n``
    the series length and ``n_days`` the category's number of sale days."""
    wk = (daily_series(daily_sales)
          .groupBy(CAT, week_ending_sunday("sale_date").alias("week"))
          .agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("days")))
    bounds = wk.groupBy(CAT).agg(F.min("week").alias("lo"), F.max("week").alias("hi"),
                                 F.sum("days").alias("n_days"))
    cal = bounds.select(CAT, "lo", "n_days",
                        (F.datediff("hi", "lo") / 7 + 1).cast("int").alias("n"),
                        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    return (cal.join(wk.select(CAT, "week", "y"), [CAT, "week"], "left")
            .select(CAT, "week", (F.datediff("week", "lo") / 7).cast("int").alias("x"),
                    F.coalesce("y", F.lit(0)).cast("long").alias("y"), "n", "n_days"))


def fit_trend(series: DataFrame) -> DataFrame:
    """Least-squares ``y = intercept + slope * x`` per category from exact
    integer sums; also the last week and index of the series."""
    agg = series.groupBy(CAT).agg(
        F.count(F.lit(1)).alias("m"), F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("y")).alias("sxy"),
        F.max("week").alias("last_week"), F.max("x").alias("last_x"))
    m, sx, sy, sxx, sxy = (F.col(c).cast("double") for c in ("m", "sx", "sy", "sxx", "sxy"))
    return (agg.withColumn("slope", (m * sxy - sx * sy) / (m * sxx - sx * sx))
               .withColumn("intercept", (sy - F.col("slope") * sx) / m)
               .select(CAT, "m", "slope", "intercept", "last_week", "last_x"))


def _predict(x: Column) -> Column:
    return F.col("intercept") + F.col("slope") * x.cast("double")


def backtest(daily_sales: DataFrame, test_weeks: int = FORECAST_TEST_WEEKS,
             min_train_weeks: int = FORECAST_MIN_TRAIN_WEEKS) -> DataFrame:
    """Hold out the last ``test_weeks`` weeks, fit on the rest, score.

    Categories with fewer than ``test_weeks + min_train_weeks`` weeks are
    skipped. Output: category, test_points, mae, rmse.
    """
    s = weekly_series(daily_sales).filter(F.col("n") >= test_weeks + min_train_weeks)
    is_test = F.col("x") >= F.col("n") - test_weeks
    fit = fit_trend(s.filter(~is_test))
    err = (s.filter(is_test).join(fit, CAT)
           .select(CAT, (_predict(F.col("x")) - F.col("y").cast("double")).alias("e")))
    return err.groupBy(CAT).agg(
        F.count(F.lit(1)).alias("test_points"),
        (_ordered_sum(F.collect_list(F.abs("e"))) / F.count(F.lit(1))).alias("mae"),
        F.sqrt(_ordered_sum(F.collect_list(F.col("e") * F.col("e"))) / F.count(F.lit(1))).alias("rmse"))


def forecast(daily_sales: DataFrame, horizon: int = FORECAST_HORIZON_WEEKS,
             min_days: int = FORECAST_MIN_DAYS) -> DataFrame:
    """Fitted weekly history plus ``horizon`` future Sundays per category
    with an 80 % band (D1, D3). Categories with fewer than ``min_days`` sale
    days give no rows."""
    s = weekly_series(daily_sales).filter(F.col("n_days") >= min_days)
    fit = fit_trend(s)
    hist = s.select(CAT, "week", "x", "y").join(fit, CAT).withColumn(
        "r", F.col("y").cast("double") - _predict(F.col("x")))
    sigma = (hist.groupBy(CAT).agg(_ordered_sum(F.collect_list(F.col("r") * F.col("r"))).alias("rss"),
                                   F.count(F.lit(1)).alias("m"))
             .select(CAT, F.sqrt(F.col("rss") / (F.col("m") - 2)).alias("sigma")))
    future = fit.select(CAT, "slope", "intercept",
                        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("i"),
                        "last_week", "last_x").select(
        CAT, "slope", "intercept", F.date_add("last_week", F.col("i") * 7).alias("week"),
        (F.col("last_x") + F.col("i")).alias("x"))
    frame = hist.select(CAT, "slope", "intercept", "week", "x").unionByName(future)
    yhat = _predict(F.col("x"))
    band = F.lit(Z80) * F.col("sigma")
    return (frame.join(sigma, CAT)
            .select(CAT, F.col("week").cast("timestamp_ntz").alias("ds"), yhat.alias("yhat"),
                    (yhat - band).alias("yhat_lower"), (yhat + band).alias("yhat_upper")))


def evaluation_summary(evaluation: DataFrame) -> DataFrame:
    """Average MAE and RMSE over categories (A8). Summed as DECIMAL(38,9): partial
    sums per task, and the same result in whatever order they meet."""
    def mean(c):
        return (F.sum(F.col(c).cast("decimal(28,9)")).cast("double") / F.count(c)).alias(f"avg_{c}")
    return evaluation.agg(
        mean("mae"), mean("rmse"),
        F.count(F.lit(1)).alias("categories"))


def worst_categories(evaluation: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` categories with the largest MAE (O2)."""
    return evaluation.orderBy(F.col("mae").desc(), F.col(CAT)).limit(k)
