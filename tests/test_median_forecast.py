"""Exact distributed median and Holt forecasting."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quotaloom.functions.median import exact_median
from quotaloom.operators import forecast as fc


def test_exact_median_matches_pandas_with_hot_group(spark):
    rng = np.random.default_rng(7)
    keys = np.where(rng.random(5000) < 0.6, "hot", rng.choice(["a", "b", "c"], 5000))
    vals = np.round(rng.gamma(2.0, 1000.0, 5000), 2)
    vals[:7] = np.nan
    pdf = pd.DataFrame({"k": keys, "v": vals})
    pdf.loc[pdf.k == "c", "v"] = 5.0  # all-equal group
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = {r.k: r.median for r in exact_median(df, ["k"], "v", partitions=16).collect()}
    want = pdf.groupby("k")["v"].median().to_dict()
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9, k


def test_exact_median_even_count(spark):
    df = spark.createDataFrame([("x", float(v)) for v in [4, 1, 3, 2]], "k string, v double")
    assert exact_median(df, ["k"], "v").first().median == 2.5


def _loop(y, a, b):
    l, t = y[0], (y[1] - y[0]) if len(y) > 1 else 0.0
    out = []
    for v in y:
        f = l + t
        nl = a * v + (1 - a) * f
        t = b * (nl - l) + (1 - b) * t
        l = nl
        out.append((f, l, t))
    return out


def test_holt_fixed_equals_loop(spark):
    ys = [100.0, 120.0, 90.0, 130.0, 150.0, 145.0]
    df = spark.createDataFrame([("k", f"2023-{i + 1:02d}", y) for i, y in enumerate(ys)], "g string, month_year string, v double")
    got = [(r.fitted, r.level, r.trend) for r in fc.holt_fixed(df, ["g"], "v", 0.4, 0.2).orderBy("month_year").collect()]
    want = _loop(ys, 0.4, 0.2)
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_fit_holt_linear_series():
    y = np.array([10.0 + 3.0 * i for i in range(24)])
    r = fc.fit_holt(y)
    assert r["sse"] < 1e-6 and abs(r["trend"] - 3.0) < 1e-6


def test_holt_forecast_per_key(spark):
    rows = [(g, f"2023-{m:02d}", float(base + step * m)) for g, base, step in (("x", 100, 5), ("y", 50, -2))
            for m in range(1, 13)]
    df = spark.createDataFrame(rows, "region string, month_year string, revenue double")
    out = {(r.region, r.step): r for r in fc.holt_forecast(df, ["region"], "revenue", 3).collect()}
    assert out[("x", 1)].month_year == "2024-01" and abs(out[("x", 3)].forecasted_revenue - (100 + 5 * 15)) < 0.01
    assert abs(out[("y", 2)].forecasted_revenue - (50 - 2 * 14)) < 0.01
