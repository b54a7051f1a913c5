"""Jobs and sources: ETL full refresh, CSV landing with keep-first in file order, sinks."""

import os

from quotaloom.plans import jobs
from quotaloom.plans.warehouse import Warehouse, from_extracts
from quotaloom.sources import landing, sinks
from quotaloom.sources.schemas import RAW_COLUMNS, RAW_FILES

SF = "/root/testdata/sf0.001"


def test_etl_job_and_downstream(spark, tmp_out):
    dq = {r.label: r for r in jobs.etl_job(spark, SF, tmp_out + "/wh").collect()}
    assert dq["opportunities"].rows_in == 6000 and dq["opportunities"].rows_out < 6000
    w = Warehouse(spark, tmp_out + "/wh", "tables")
    assert w.revenue.count() == dq["revenue"].rows_out
    paths = jobs.kpi_job(spark, tmp_out + "/wh", tmp_out + "/kpi")
    assert len(paths) == 6
    back = landing.read_export(spark, tmp_out + "/kpi", "win_rate")
    assert back.count() > 0 and dict(back.dtypes)["win_rate"] == "double"
    names = jobs.create_views(spark, w)
    assert "vw_exec_kpi_summary" in names
    assert jobs.query(spark, "SELECT COUNT(*) AS n FROM vw_pipeline_health").first().n > 0


def _write_extracts(root):
    rows = {
        "reps": [["R001", " alice smith", "north", "nyc metro", "M", "2020-01-01"],
                 ["R001", "dup", "south", "texas", "M", "2020-01-01"],
                 ["R002", "bob", "east", "mid-atlantic", "", "bad"]],
        "opportunities": [["O1", "R001", "P001", "C001", "2023-01-15", "2023-03-01", "Closed Won", "1000", "100", "45", "1", "1"],
                          ["O1", "R001", "P001", "C001", "2023-01-15", "2023-03-01", "Closed Won", "9999", "100", "45", "1", "1"],
                          ["O2", "R002", "P001", "C002", "2023-02-01", "", "Proposal", "500", "150", "-20", "", "0"]],
        "revenue": [["REV1", "O1", "R001", "P001", "2023-03-01", "1000", "2023-03"]],
        "quotas": [["Q1", "R001", "2023-03", "2000"]],
        "forecasts": [["F1", "R001", "2023-03", "1100", "2023-02-01"]],
        "products": [["P001", "Suite", "Software", "100", "40"]],
        "campaigns": [["C001", "Blast A", " a "], ["C002", "Blast B", "b"]],
    }
    os.makedirs(root, exist_ok=True)
    for name, rs in rows.items():
        with open(os.path.join(root, RAW_FILES[name]), "w") as f:
            f.write(",".join(RAW_COLUMNS[name]) + "\n")
            for r in rs:
                f.write(",".join(r) + "\n")


def test_csv_landing_keeps_first_in_file_order(spark, tmp_out):
    _write_extracts(tmp_out + "/raw")
    w = from_extracts(spark, tmp_out + "/raw")
    reps = {r.rep_id: r for r in w.reps.collect()}
    assert reps["R001"].rep_name == "Alice Smith" and reps["R002"].territory == "Mid-Atlantic"
    assert reps["R002"].manager is None and reps["R002"].hire_date is None
    o = {r.opportunity_id: r for r in w.opportunities.collect()}
    assert float(o["O1"].deal_value) == 1000.0
    assert o["O2"].probability == 100.0 and o["O2"].days_in_pipeline == 20 and o["O2"].is_won == 0
    assert [r.campaign_type for r in w.campaigns.orderBy("campaign_id").collect()] == ["A", "B"]
    sinks.write_table(w.reps, tmp_out + "/out/reps", "replace", "csv")
    assert spark.read.option("header", True).csv(tmp_out + "/out/reps").count() == 2


def test_create_schema_and_report_job(spark, tmp_out):
    names = jobs.create_schema(spark, tmp_out + "/decl")
    assert "fact_revenue" in names
    cols = [r.col_name for r in spark.sql("DESCRIBE TABLE dim_reps").collect()]
    assert cols[:6] == ["rep_id", "rep_name", "region", "territory", "manager", "hire_date"]
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
    jobs.etl_job(spark, SF, tmp_out + "/wh")
    jobs.report_job(spark, tmp_out + "/wh", tmp_out + "/rep")
    q = spark.read.option("header", True).csv(tmp_out + "/rep/quota_attainment")
    assert "attainment_band" not in q.columns
    s = spark.read.option("header", True).csv(tmp_out + "/rep/executive_summary")
    assert s.count() == 5


def test_extract_files_then_etl_equals_direct_path(spark, tmp_out):
    from pyspark.sql import functions as F
    from quotaloom.plans.warehouse import from_testdata
    jobs.extract_job(spark, SF, tmp_out + "/raw")
    w_csv = from_extracts(spark, tmp_out + "/raw")
    w_pq = from_testdata(spark, SF)
    norm = lambda df: df.select(*[F.col(c).cast("string").alias(c) for c in sorted(df.columns)])
    for t in ("opportunities", "reps", "products", "campaigns", "revenue"):
        a, b = norm(getattr(w_csv, t)), norm(getattr(w_pq, t))
        assert a.count() == b.count() and a.exceptAll(b).count() == 0, t


def test_run_all_via_files_publishes_every_dataset(spark, tmp_out):
    res = jobs.run_all(spark, SF, tmp_out + "/run", via_files=True)
    assert all(not isinstance(v, Exception) for v in res.values()), res
    ex = tmp_out + "/run/exports"
    fc = spark.read.option("header", True).csv(ex + "/forecast/revenue_forecast").collect()
    assert len(fc) == 3 and all(float(r.forecasted_revenue) == float(r.forecasted_revenue) for r in fc)
    t = spark.read.option("header", True).csv(ex + "/ab/t_test_results").first()
    assert t.cohens_d is not None and t.conclusion
    c = spark.read.option("header", True).csv(ex + "/ab/chi_square_results").first()
    assert int(c.won_a) + int(c.lost_a) == int(c.n_a)
    assert spark.read.option("header", True).csv(ex + "/ab/campaign_summary").count() == 5
    import csv
    import glob
    months = []
    for part in sorted(glob.glob(ex + "/kpi/mom_variance/part-*.csv")):  # part files in write order
        with open(part) as f:
            months += [r["month_year"] for r in csv.DictReader(f)]
    assert len(months) > 0 and months == sorted(months)  # exported in the reference's order


def test_load_modes_replace_append_fail(spark, tmp_out):
    import pytest
    df = spark.range(5).withColumnRenamed("id", "k")
    path = tmp_out + "/modes"
    sinks.write_table(df, path, "replace")
    sinks.write_table(df, path, "append")
    assert spark.read.parquet(path).count() == 10
    sinks.write_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        sinks.write_table(df, path, "fail")
