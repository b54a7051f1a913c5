"""Forecasting (FC1–FC5): Holt's linear trend method per key.

* FC1 ``holt_fixed``: given α, β (and optionally l0, b0), the level/trend recursion runs
  as a native ``aggregate`` fold over each key's month-ordered series — no Python.
* FC2 ``holt_forecast``: parameters fitted per key by least squares. For fixed (α, β)
  the one-step errors are affine in (l0, b0), so (l0, b0) come from 2×2 normal
  equations and (α, β) from a coarse-to-fine grid; one ``applyInPandas`` call per key
  on that key's monthly series (a few hundred rows at most), NumPy only.
* FC3–FC5: metrics, horizon labels and chart data over the FC1 output, in SQL terms.

Grid bounds: α ∈ (0, 1), β ∈ [0, 1]. A key's series covers every month from its first to its
last: a month without rows counts as 0, as a blank sum does in the dashboard measures.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import month_start, rnd

_PT = "struct<month_year:string,y:double,fitted:double,level:double,trend:double>"


def series(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key: the month-ordered array of (month_year, y)."""
    pts = F.array_sort(F.collect_list(F.struct(F.col("month_year"), F.col(value).cast("double").alias("y"))))
    return df.groupBy(*keys).agg(pts.alias("pts")) if keys else df.agg(pts.alias("pts"))


def holt_fixed(df: DataFrame, keys: Sequence[str], value: str, alpha: float, beta: float,
               l0: float | None = None, b0: float | None = None) -> DataFrame:
    """FC1: fitted value, level and trend per month. Default start: l0 = y1, b0 = y2 − y1."""
    keys = list(keys)
    s = series(df, keys, value)
    y1 = F.col("pts")[0]["y"]
    y2 = F.when(F.size("pts") > 1, F.col("pts")[1]["y"] - y1).otherwise(F.lit(0.0))
    init = F.struct((F.lit(float(l0)) if l0 is not None else y1).alias("l"),
                    (F.lit(float(b0)) if b0 is not None else y2).alias("b"),
                    F.array().cast(f"array<{_PT}>").alias("out"))
    a, ca, b, cb = F.lit(alpha), F.lit(1.0 - alpha), F.lit(beta), F.lit(1.0 - beta)

    def step(acc, p):
        f = acc["l"] + acc["b"]
        lvl = a * p["y"] + ca * f
        trd = b * (lvl - acc["l"]) + cb * acc["b"]
        row = F.struct(p["month_year"].alias("month_year"), p["y"].alias("y"), f.alias("fitted"),
                       lvl.alias("level"), trd.alias("trend"))
        return F.struct(lvl.alias("l"), trd.alias("b"), F.concat(acc["out"], F.array(row)).alias("out"))

    folded = s.select(*keys, F.aggregate("pts", init, step)["out"].alias("out"))
    return folded.select(*keys, F.inline("out"))


def forecast_metrics(fitted: DataFrame, keys: Sequence[str], alpha: float | None = None) -> DataFrame:
    """FC3: in-sample MAE, RMSE, MAPE (y = 0 skipped), rounded to 2; α rounded to 4."""
    e = F.col("y") - F.col("fitted")
    aggs = [rnd(F.avg(F.abs(e)), 2).alias("mae"), rnd(F.sqrt(F.avg(e * e)), 2).alias("rmse"),
            rnd(F.avg(F.abs(e / F.when(F.col("y") != 0, F.col("y")))) * F.lit(100.0), 2).alias("mape")]
    out = fitted.groupBy(*keys).agg(*aggs) if keys else fitted.agg(*aggs)
    if alpha is not None:
        out = out.withColumn("alpha", rnd(F.lit(alpha), 4))
    return out


def forecast_horizon(fitted: DataFrame, keys: Sequence[str], horizon: int = 3) -> DataFrame:
    """FC4: months after the last fitted month, value = level + h·trend (2 dp)."""
    keys = list(keys)
    last = F.max(F.struct("month_year", "level", "trend")).alias("last")
    t = fitted.groupBy(*keys).agg(last) if keys else fitted.agg(last)
    t = t.select(*keys, "last.*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return t.select(*keys, F.date_format(F.add_months(month_start("month_year"), F.col("h")), "yyyy-MM").alias("month_year"),
                    rnd(F.col("level") + F.col("h").cast("double") * F.col("trend"), 2).alias("forecasted_revenue"))


def forecast_chart_data(fitted: DataFrame, keys: Sequence[str], horizon: int = 3) -> DataFrame:
    """FC5: long table (month_year, series, value) of actual, fitted and forecast."""
    keys = list(keys)
    actual = fitted.select(*keys, "month_year", F.lit("actual").alias("series"), rnd("y", 2).alias("value"))
    fit = fitted.select(*keys, "month_year", F.lit("fitted").alias("series"), rnd("fitted", 2).alias("value"))
    fc = forecast_horizon(fitted, keys, horizon).select(*keys, "month_year", F.lit("forecast").alias("series"),
                                                        F.col("forecasted_revenue").alias("value"))
    return actual.unionByName(fit).unionByName(fc)


# ── FC2: per-key least-squares fit ───────────────────────────

#: Widths of (α, β) below which the grid is not refined; reported are four digits.
TOLERANCE = 1e-7


def _sse_grid(y: np.ndarray, alphas: np.ndarray, betas: np.ndarray):
    """For each (α, β) on the grid: optimal (l0, b0) and SSE, vectorised over the grid."""
    A, B = np.meshgrid(alphas, betas, indexing="ij")
    A, B = A.ravel(), B.ravel()
    g = A.size
    # level and trend as affine forms c + u·l0 + v·b0: rows (c, u, v), each contiguous over the grid
    lvl, trd = np.zeros((3, g)), np.zeros((3, g))
    lvl[1], trd[2] = 1.0, 1.0
    f, new_lvl, products = np.empty((3, g)), np.empty((3, g)), np.empty((3, g))
    suu_suv, svv, s_r = np.zeros((2, g)), np.zeros(g), np.zeros((3, g))
    rest_a, rest_b = 1 - A, 1 - B
    for yt in y:
        np.add(lvl, trd, out=f)
        np.multiply(rest_a, f, out=new_lvl)
        new_lvl[0] += A * yt
        np.subtract(yt, f[0], out=f[0])  # now (r, u, v)
        suu_suv += np.multiply(f[1], f[1:], out=products[:2])
        svv += f[2] * f[2]
        s_r += np.multiply(f, f[0], out=products)
        trd *= rest_b
        np.subtract(new_lvl, lvl, out=lvl)
        lvl *= B
        trd += lvl
        lvl, new_lvl = new_lvl, lvl
    (suu, suv), (srr, sur, svr) = suu_suv, s_r
    det = suu * svv - suv * suv
    ok = np.abs(det) > 1e-12 * np.maximum(1.0, suu * svv)
    l0 = np.where(ok, (sur * svv - svr * suv) / np.where(ok, det, 1.0), y[0])
    b0 = np.where(ok, (svr * suu - sur * suv) / np.where(ok, det, 1.0), y[1] - y[0] if len(y) > 1 else 0.0)
    sse = srr - 2 * (l0 * sur + b0 * svr) + (l0 * l0 * suu + 2 * l0 * b0 * suv + b0 * b0 * svv)
    return A, B, l0, b0, sse


def fit_holt(y: np.ndarray) -> dict:
    """Least-squares Holt fit: a grid over (α, β), zoomed around its best point until it is finer than TOLERANCE.

    One rule for every length: where the normal equations leave (l0, b0) open, as for one or two points, the
    start is l0 = y1, b0 = y2 − y1 (no trend for a single point).
    """
    lo_a, hi_a, lo_b, hi_b = 0.01, 0.99, 0.0, 1.0
    best = None
    while best is None or max(hi_a - lo_a, hi_b - lo_b) > TOLERANCE:
        A, B, l0, b0, sse = _sse_grid(y, np.linspace(lo_a, hi_a, 25), np.linspace(lo_b, hi_b, 25))
        i = int(np.nanargmin(sse))
        best = (A[i], B[i], l0[i], b0[i], sse[i])
        wa, wb = (hi_a - lo_a) / 12, (hi_b - lo_b) / 12
        lo_a, hi_a = max(1e-4, best[0] - wa), min(1 - 1e-4, best[0] + wa)
        lo_b, hi_b = max(0.0, best[1] - wb), min(1.0, best[1] + wb)
    a, b, l, t, s = best
    for yt in y:
        f = l + t
        nl = a * yt + (1 - a) * f
        t = b * (nl - l) + (1 - b) * t
        l = nl
    return {"alpha": float(a), "beta": float(b), "l0": float(best[2]), "b0": float(best[3]), "sse": float(s),
            "level": float(l), "trend": float(t)}


def holt_forecast(df: DataFrame, keys: Sequence[str], value: str, horizon: int = 3) -> DataFrame:
    """FC2: per key, fit Holt by least squares and forecast ``horizon`` months ahead.

    The series are small and the fits are not: rows are dealt to a fixed number of partitions by key, as partitions
    merged by their size would leave all fits to one task or two.
    """
    keys = list(keys)
    monthly = df.groupBy(*keys, "month_year").agg(F.sum(value).cast("double").alias("y"))
    key_fields = [f for f in monthly.schema.fields if f.name in keys]
    out_schema = T.StructType(key_fields + [
        T.StructField("month_year", T.StringType()), T.StructField("step", T.IntegerType()),
        T.StructField("forecasted_revenue", T.DoubleType()), T.StructField("alpha", T.DoubleType()),
        T.StructField("beta", T.DoubleType()), T.StructField("sse", T.DoubleType())])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pd.Series(pdf["y"].to_numpy(dtype="float64"), index=pd.PeriodIndex(pdf["month_year"], freq="M")).sort_index()
        y = y.reindex(pd.period_range(y.index[0], y.index[-1], freq="M"), fill_value=0.0)
        r = fit_holt(y.to_numpy())
        last = y.index[-1]
        rows = []
        for h in range(1, horizon + 1):
            row = {k: pdf[k].iloc[0] for k in keys}
            row.update({"month_year": str(last + h), "step": h,
                        "forecasted_revenue": r["level"] + h * r["trend"],
                        "alpha": r["alpha"], "beta": r["beta"], "sse": r["sse"]})
            rows.append(row)
        return pd.DataFrame(rows, columns=[f.name for f in out_schema.fields])

    if not keys:
        monthly = monthly.withColumn("_all", F.lit(1))
        out_schema = T.StructType([T.StructField("_all", T.IntegerType())] + list(out_schema.fields))
        keys = ["_all"]
    if keys != ["_all"]:
        monthly = monthly.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    fitted = monthly.groupBy(*keys).applyInPandas(fit, out_schema).withColumns(
        {"forecasted_revenue": rnd("forecasted_revenue", 2), "alpha": rnd("alpha", 4), "beta": rnd("beta", 4)})
    return fitted.drop("_all")
