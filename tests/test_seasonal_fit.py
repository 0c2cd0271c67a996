"""The seasonal model solved in Spark against the grouped numpy one."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from storelake import schemas
from storelake.operators import seasonal, seasonal_fit

START = dt.date(2021, 1, 3)                    # a Sunday


def sales(spark, categories):
    g = np.random.default_rng(1)
    rows = []
    for name, weeks in categories.items():
        for i in range(weeks):
            y = 80 + 0.4 * i + 15 * np.sin(2 * np.pi * i / seasonal.WEEKS_PER_YEAR) + g.normal() * 6
            rows.append((START + dt.timedelta(days=7 * i + int(g.integers(-3, 4))), name, max(0, int(y))))
    return spark.createDataFrame(rows, schemas.DAILY_SALES)


def rows(df, key):
    return {tuple(r[k] for k in key): [r[c] for c, t in df.dtypes if t == "double"] for r in df.collect()}


def test_equal_to_the_grouped_numpy_model(spark):
    ds = sales(spark, {"long": 260, "year": 60, "short": 31, "too short": 12, "empty name": 40})
    for a, b, key in ((seasonal.seasonal_forecast(ds), seasonal_fit.seasonal_forecast(ds), ("category_english", "ds")),
                      (seasonal.seasonal_backtest(ds), seasonal_fit.seasonal_backtest(ds), ("category_english",))):
        x, y = rows(a, key), rows(b, key)
        assert x.keys() == y.keys() and len(x) > 2
        for k in x:
            np.testing.assert_allclose(x[k], y[k], rtol=1e-6, atol=1e-6)


def test_solve(spark):
    g = np.random.default_rng(2)
    for d in (1, 2, 5, 8):
        q = g.normal(size=(d, d))
        a, b = q @ q.T + np.eye(d), g.normal(size=d)
        matrix = F.array(*[F.array(*[F.lit(float(v)) for v in [*a[i], b[i]]]) for i in range(d)])
        got = spark.range(1).select(seasonal_fit.solve(matrix, d).alias("x")).first().x
        np.testing.assert_allclose(got, np.linalg.solve(a, b), rtol=1e-9)


def test_the_fit_does_not_depend_on_partitions(spark):
    ds = sales(spark, {"a": 150, "b": 90})
    one = rows(seasonal_fit.seasonal_forecast(ds.repartition(1)), ("category_english", "ds"))
    many = rows(seasonal_fit.seasonal_forecast(ds.repartition(13)), ("category_english", "ds"))
    assert one == many


def test_nothing_is_collected_but_sums(spark):
    from storelake.operators.forecast import weekly_series
    plan = seasonal_fit.fit_seasonal(weekly_series(sales(spark, {"a": 40})))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Pandas" not in plan and "ArrowEval" not in plan


def test_no_sales(spark):
    none = spark.createDataFrame([], schemas.DAILY_SALES)
    assert seasonal_fit.seasonal_forecast(none).count() == 0 and seasonal_fit.seasonal_backtest(none).count() == 0
