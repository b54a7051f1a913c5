"""Golden rows: published KPI exports recomputed from the published processed tables.

Fixtures in tests/golden are a few copied rows (two reps, and the monthly revenue totals);
they are read as raw text and go through the same cleaning + KPI code as any extract.
"""

import csv
import os

import pytest
from pyspark.sql import functions as F

from quotaloom.operators import clean, kpis

G = os.path.join(os.path.dirname(__file__), "golden")


def _raw(spark, name):
    with open(os.path.join(G, name)) as f:
        rows = list(csv.reader(f))
    schema = ", ".join(f"{c} string" for c in rows[0])
    return _seq(spark.createDataFrame([tuple(r) for r in rows[1:]], schema))


def _seq(df):
    return df.coalesce(1).withColumn("_seq", F.monotonically_increasing_id())


def _expected(name):
    with open(os.path.join(G, name)) as f:
        return list(csv.DictReader(f))


@pytest.fixture(scope="module")
def star(spark):
    return (clean.clean_reps(_raw(spark, "reps.csv")), clean.clean_revenue(_raw(spark, "revenue.csv")),
            clean.clean_quotas(_raw(spark, "quotas.csv")), clean.clean_forecasts(_raw(spark, "forecasts.csv")))


def test_quota_attainment_golden(star):
    reps, revenue, quotas, _ = star
    got = {(r.rep_name, r.month_year): r for r in kpis.quota_attainment(quotas, reps, revenue).collect()}
    exp = _expected("expected_quota_attainment.csv")
    assert len(got) == len(exp) == 48
    for e in exp:
        g = got[(e["rep_name"], e["month_year"])]
        assert abs(g.actual_revenue - float(e["actual_revenue"])) < 1e-6
        assert g.quota_attainment == float(e["quota_attainment"])
        assert g.attainment_band == e["attainment_band"]
        assert (g.region, g.territory) == (e["region"], e["territory"])


def test_forecast_accuracy_golden(star):
    reps, revenue, _, forecasts = star
    got = {(r.rep_name, r.month_year): r for r in kpis.forecast_accuracy(forecasts, reps, revenue).collect()}
    exp = _expected("expected_forecast_accuracy.csv")
    assert len(got) == len(exp) == 23
    for e in exp:
        g = got[(e["rep_name"], e["month_year"])]
        assert abs(g.abs_error - float(e["abs_error"])) < 1e-6
        assert g.forecast_accuracy == float(e["forecast_accuracy"]) and g.mape == float(e["mape"])


def test_mom_variance_golden(spark):
    exp = _expected("expected_mom_variance.csv")
    months = [(exp[0]["month_year"][:5] + "02", exp[0]["prev_revenue"])] + [(e["month_year"], e["total_revenue"]) for e in exp]
    rows = [(f"V{i}", "O", "R", "P", f"{m}-15", v, m) for i, (m, v) in enumerate(months)]
    rev = clean.clean_revenue(spark.createDataFrame(
        rows, "revenue_id string, opportunity_id string, rep_id string, product_id string, close_date string, "
              "revenue string, month_year string"), unique=True)
    got = {r.month_year: r for r in kpis.mom_variance(rev).collect()}
    assert len(got) == len(exp) == 22
    for e in exp:
        g = got[e["month_year"]]
        assert abs(g.variance - float(e["variance"])) < 1e-6 and g.variance_pct == float(e["variance_pct"])


def test_holt_fit_on_published_series():
    """The reference's 23-month revenue series: a least-squares Holt fit reaches an SSE at
    or below the straight-line fit (2.21e11), and forecasts are linear in the horizon."""
    from quotaloom.operators import forecast as fc
    import numpy as np
    exp = _expected("expected_mom_variance.csv")
    y = np.array([float(exp[0]["prev_revenue"])] + [float(e["total_revenue"]) for e in exp])
    assert len(y) == 23
    r = fc.fit_holt(y)
    assert r["sse"] <= 2.21e11
    f = [r["level"] + h * r["trend"] for h in (1, 2, 3)]
    assert abs((f[2] - f[1]) - (f[1] - f[0])) < 1e-6
    assert fc.fit_holt(y) == r  # deterministic
