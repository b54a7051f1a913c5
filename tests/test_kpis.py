"""KPI semantics on toy star schemas, and the fan-out rewrite against the naive join."""

import datetime as dt


from quotaloom.functions.exprs import dax_band, kpi_band
from quotaloom.operators import kpis

REPS = "rep_id string, rep_name string, region string, territory string"
OPPS = ("opportunity_id string, rep_id string, stage string, created_date date, close_date date, deal_value decimal(18,2), "
        "probability double, days_in_pipeline int, is_won int, is_closed int")
REV = "revenue_id string, rep_id string, close_date date, revenue decimal(18,2), month_year string"


def d(s):
    return dt.date.fromisoformat(s)


def test_bands(spark):
    df = spark.createDataFrame([(0.5,), (0.8,), (1.0,), (1.2,), (None,)], "a double")
    got = [(r[0], r[1]) for r in df.select(kpi_band("a"), dax_band("a")).collect()]
    assert got == [("<50%", "At Risk (50-80%)"), ("50-80%", "Near Target (80-100%)"),
                   ("80-100%", "On Track (100-120%)"), ("100-120%", "Exceeds (>120%)"), (None, "Critical (<50%)")]


def _schema(spark):
    from decimal import Decimal as Dm
    reps = spark.createDataFrame([("R1", "Ann Lee", "East", "Florida"), ("R2", "Bo Li", "East", "Florida"),
                                  ("R3", "Cy Ho", "West", "California")], REPS)
    opps = spark.createDataFrame([
        ("O1", "R1", "Closed Won", d("2023-01-02"), d("2023-02-01"), Dm("100.00"), 100.0, 30, 1, 1),
        ("O2", "R1", "Closed Lost", d("2023-01-05"), d("2023-02-10"), Dm("50.00"), 0.0, 36, 0, 1),
        ("O3", "R2", "Proposal", d("2023-01-07"), None, Dm("70.00"), 50.0, 10, 0, 0),
        ("O4", "R3", "Closed Won", d("2023-03-01"), d("2023-03-20"), Dm("30.00"), 100.0, 19, 1, 1)], OPPS)
    rev = spark.createDataFrame([("V1", "R1", d("2023-02-01"), Dm("100.00"), "2023-02"),
                                 ("V4", "R3", d("2023-03-20"), Dm("30.00"), "2023-03"),
                                 ("V5", "R3", d("2023-03-22"), Dm("20.00"), "2023-03")], REV)
    return reps, opps, rev


def test_win_rate_and_invariants(spark):
    reps, opps, _ = _schema(spark)
    rows = {r.rep_name: r for r in kpis.win_rate(opps, reps).collect()}
    assert rows["Ann Lee"].total_closed == 2 and rows["Ann Lee"].won == 1 and rows["Ann Lee"].win_rate == 0.5
    assert all(0 <= r.win_rate <= 1 for r in rows.values())


def test_velocity_null_without_closed(spark):
    reps, opps, _ = _schema(spark)
    v = {(r.region, r.month_year): r for r in kpis.pipeline_velocity(opps, reps).collect()}
    assert v[("East", "2023-01")].win_rate == 0.5
    assert all(r.pipeline_velocity is None or r.pipeline_velocity >= 0 for r in v.values())


def test_forecast_accuracy_rules(spark):
    reps, _, rev = _schema(spark)
    f = spark.createDataFrame([("R1", "2023-02", 300.0), ("R2", "2023-02", 10.0)],
                              "rep_id string, month_year string, forecasted_rev double")
    got = {r.rep_name: r for r in kpis.forecast_accuracy(f, reps, rev).collect()}
    assert got["Ann Lee"].forecast_accuracy == 0.0 and got["Ann Lee"].mape == 200.0  # clipped at 0
    assert got["Bo Li"].actual_revenue == 0.0 and got["Bo Li"].forecast_accuracy is None
    sql = {r.rep_name: r for r in kpis.forecast_accuracy_sql(f, reps, rev).collect()}
    assert sql["Ann Lee"].forecast_accuracy == -1.0


def test_quota_without_revenue(spark):
    reps, _, rev = _schema(spark)
    q = spark.createDataFrame([("R2", "2023-02", 100.0)], "rep_id string, month_year string, quota_amount double")
    r = kpis.quota_attainment(q, reps, rev).first()
    assert r.actual_revenue == 0.0 and r.quota_attainment == 0.0 and r.attainment_band == "<50%"


def test_fanout_rewrite_equals_naive_join(spark):
    reps, opps, rev = _schema(spark)
    reps = reps.union(spark.createDataFrame([("R4", "Di No", "West", "California")], REPS))  # rep without facts
    got = {r.territory: r for r in kpis.territory_summary_fanout(opps, reps, rev).collect()}
    for n, df in (("r", reps), ("o", opps), ("v", rev)):
        df.createOrReplaceTempView(f"t_{n}")
    naive = spark.sql("""
        SELECT r.territory, COUNT(DISTINCT o.opportunity_id) AS a, COUNT(DISTINCT v.revenue_id) AS b,
               ROUND(SUM(v.revenue), 2) AS c, AVG(v.revenue) AS e, AVG(o.days_in_pipeline) AS f
        FROM t_r r LEFT JOIN t_o o ON o.rep_id = r.rep_id LEFT JOIN t_v v ON v.rep_id = r.rep_id
        GROUP BY r.territory""").collect()
    for n in naive:
        g = got[n.territory]
        assert (g.total_opportunities, g.closed_won_deals) == (n.a, n.b)
        assert abs(g.total_revenue - float(n.c)) < 1e-9
        assert abs(g.avg_deal_size - round(float(n.e), 2)) < 1e-9
        assert abs(g.avg_sales_cycle_days - round(float(n.f), 1)) < 1e-9


def test_mom_variance_drops_first_month(spark):
    _, _, rev = _schema(spark)
    m = kpis.mom_variance(rev).collect()
    assert len(m) == 1 and m[0].month_year == "2023-03" and m[0].variance_pct == -50.0
