"""Values and sizes at which a rule once failed."""

import pytest
from pyspark.sql import functions as F

from quotaloom.functions.exprs import month_start, rnd, to_number, weighted
from quotaloom.functions.median import exact_median
from quotaloom.operators import clean, experiments as ab, forecast as fc, kpis
from quotaloom.plans import jobs
from quotaloom.plans.warehouse import Warehouse
from quotaloom.sources import landing
from quotaloom.sources.schemas import RAW_COLUMNS, RAW_FILES

SF = "/root/testdata/sf0.001"


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_rounding_does_not_saturate(spark):
    assert one(spark, rnd(F.lit(1e17), 2)) == 1e17
    assert one(spark, rnd(F.lit(-123456789012345680.0), 4)) == -123456789012345680.0
    assert one(spark, rnd(F.lit(2.675), 2)) == 2.68 or one(spark, rnd(F.lit(2.675), 2)) == 2.67


def test_hot_rep_many_to_many(spark):
    reps = spark.createDataFrame([(1, "n", "r", "t")], "rep_id long, rep_name string, region string, territory string")
    opps = spark.range(100_000).selectExpr(
        "id AS opportunity_id", "1L AS rep_id", "2000000000 AS days_in_pipeline", "1 AS is_won", "1 AS is_closed", "DATE'2023-01-15' AS close_date")
    rev = spark.range(100_000).selectExpr(
        "id AS revenue_id", "1L AS rep_id", "CAST(10000000.00 AS DECIMAL(18,2)) AS revenue", "DATE'2023-01-15' AS close_date")
    r = kpis.territory_summary_fanout(opps, reps, rev).first()
    assert r.total_revenue == 1e17 and r.avg_sales_cycle_days == 2e9
    quotas = spark.createDataFrame([(1, "2023-01")], "rep_id long, month_year string").withColumn(
        "quota_amount", F.lit(100).cast("decimal(18,2)"))
    v = kpis.exec_kpi_summary(opps, reps, rev, quotas).first()
    assert v.actual_revenue == 1e17 and v.won_opps == 10**10 and v.avg_cycle_days == 2e9


def test_numbers_and_months_from_text(spark):
    df = spark.createDataFrame([("12d",), ("12.7",), (" 1e3 ",), ("-.5",), ("0x10",), ("abc",), ("Infinity",)], "x string")
    assert [r[0] for r in df.select(to_number(df, "x")).collect()] == [None, 12.7, 1000.0, -0.5, None, None, float("inf")]
    months = spark.createDataFrame([("2023-04",), ("Jan 2023",), (None,)], "m string")
    assert [str(r[0]) for r in months.select(month_start("m")).collect()] == ["2023-04-01", "None", "None"]


def opportunities(spark, *values):
    rows = [(f"O{i}", "R", "P", "C", "2023-01-01", "2023-02-01", "Closed Won", v, "50", "3", "1", "1", i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_COLUMNS["opportunities"]) + ", _seq long")


def test_amounts_are_judged_as_stored(spark):
    raw = opportunities(spark, "1e20", "Infinity", "0.004", "0.006", "12.50", "12d", None)
    assert {r.opportunity_id: float(r.deal_value) for r in clean.clean_opportunities(raw).collect()} == {"O3": 0.01, "O4": 12.5}
    counts = {r.rule: r.rows for r in clean.dq_rule_counts({"opportunities": raw}).collect()}
    assert counts["dropped_deal_value_not_positive"] == 5 and counts["rows_out"] == 2


def test_keep_first_needs_an_order(spark):
    with pytest.raises(ValueError, match="_seq"):
        clean.clean_opportunities(opportunities(spark, "1").drop("_seq"))


def test_weighted_value_is_not_quantised(spark):
    got = one(spark, weighted(F.lit(3_000_000).cast("decimal(18,2)"), F.lit(33.333333)))
    assert round(float(got), 2) == 999999.99


def test_flat_groups_do_not_stop_other_keys(spark):
    rows = [("flat", "A", 5, 1), ("flat", "A", 5, 0), ("flat", "B", 5, 1), ("flat", "B", 5, 0), ("one", "A", 3, 1)]
    rows += [("real", t, 10 + k + (t == "B"), k % 2) for t in "AB" for k in range(20)]
    df = spark.createDataFrame(rows, "region string, campaign_type string, deal_value long, is_won long")
    got = {r.region: r for r in ab.ab_tests_grouped(df, ["region"]).collect()}
    assert got["flat"].t_statistic is None and got["flat"].p_value is None and got["flat"].cohens_d == 0
    assert got["one"].t_statistic is None and 0 < got["real"].p_value < 1


def test_median_of_a_mostly_constant_group(spark):
    df = spark.range(200_000).selectExpr("'g' AS k", "CASE WHEN id % 10 < 9 THEN 25.0D ELSE id / 7.0D END AS v")
    assert exact_median(df, ["k"], "v").first()["median"] == 25.0
    # equal values are one row before the first shuffle of values
    n = df.groupBy("k", "v").count().count()
    assert n <= 20_001


def test_median_builds_no_job_and_matches_any_sign(spark):
    import pandas as pd

    rows = [("a", float(v)) for v in (-3, -2.5, 0, 0, 1e-9, 4, 1e12, -1e-300)] + [("b", 7.0), ("c", -1.0), ("c", 2.0), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    want = pd.DataFrame(rows, columns=["k", "v"]).dropna().groupby("k").v.median().to_dict()
    assert {r.k: r["median"] for r in exact_median(df, ["k"], "v").collect()} == want


def test_holt_has_one_rule_for_every_length():
    import numpy as np

    two = fc.fit_holt(np.array([1.0, 5.0]))
    assert abs(two["level"] + two["trend"] - 9.0) < 1e-6  # the line through both points goes on
    single = fc.fit_holt(np.array([4.0]))
    assert single["trend"] == 0.0 and single["level"] == 4.0


def test_holt_fit_is_converged():
    import numpy as np

    draw = np.random.default_rng(6)
    for _ in range(5):
        y = 100 + draw.normal(0, 10, 24).cumsum()
        r = fc.fit_holt(y)
        a, b = np.linspace(max(1e-4, r["alpha"] - 1e-3), min(1 - 1e-4, r["alpha"] + 1e-3), 41), np.linspace(max(0, r["beta"] - 1e-3), min(1, r["beta"] + 1e-3), 41)
        assert r["sse"] <= fc._sse_grid(y, a, b)[4].min() * (1 + 1e-9)


def test_holt_fills_months_without_rows(spark):
    gap = spark.createDataFrame([("2023-01", 10.0), ("2023-02", 11.0), ("2023-05", 12.0)], "month_year string, v double")
    full = spark.createDataFrame([("2023-01", 10.0), ("2023-02", 11.0), ("2023-03", 0.0), ("2023-04", 0.0), ("2023-05", 12.0)], "month_year string, v double")
    assert fc.holt_forecast(gap, [], "v").collect() == fc.holt_forecast(full, [], "v").collect()


def test_extract_with_quotes_line_breaks_and_other_order(spark, tmp_path):
    path = tmp_path / RAW_FILES["products"]
    path.write_text('category,product_id,product_name,cost_price,unit_price\r\nTools,P1,"19"" rack, large",5,9\r\n"Big\nthings",P2,plain,1,2\r\n')
    got = {r.product_id: r for r in landing.read_extract(spark, str(tmp_path), "products").collect()}
    assert got["P1"].product_name == '19" rack, large' and got["P1"].category == "Tools" and got["P1"].unit_price == "9"
    assert got["P2"].category == "Big\nthings"
    path.write_text("product_id,product_name\nP1,x\n")
    with pytest.raises(ValueError, match="category"):
        landing.read_extract(spark, str(tmp_path), "products")


def test_csv_warehouse_feeds_the_kpi_job(spark, tmp_path):
    dst = str(tmp_path / "wh")
    jobs.etl_job(spark, SF, dst, fmt="csv")
    jobs.kpi_job(spark, dst, str(tmp_path / "kpi"), fmt="csv")
    want = kpis.total_revenue(Warehouse(spark, SF).revenue).first()[0]
    assert kpis.total_revenue(Warehouse(spark, dst, "tables", fmt="csv").revenue).first()[0] == want


def test_catalog_tables_read_what_the_etl_wrote(spark, tmp_path):
    dst = str(tmp_path / "wh")
    jobs.etl_job(spark, SF, dst)
    names = jobs.create_schema(spark, dst)
    try:
        for name in names:
            want = Warehouse(spark, dst, "tables")._stored(name)
            assert spark.table(name).count() == want.count() > 0
            spark.sql(f"SELECT * FROM {name} LIMIT 3").collect()
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
