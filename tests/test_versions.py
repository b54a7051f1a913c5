"""Committed refreshes: whole versions only, loads by mode, catalog tables that follow, jobs over a CSV warehouse."""

import os

import pytest
from pyspark.sql import functions as F

from quotaloom.operators import kpis
from quotaloom.plans import jobs
from quotaloom.plans.warehouse import Warehouse
from quotaloom.sources import landing, versions
from quotaloom.sources.schemas import PROCESSED

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    dst = str(tmp_path_factory.mktemp("versions") / "wh")
    jobs.etl_job(spark, SF, dst)
    return dst


def counts(w):
    return {t: df.count() for t, df in w.tables().items()}


@pytest.mark.parametrize("killed", [False, True])
def test_a_run_that_dies_in_wave_two_leaves_the_old_tables(spark, warehouse, monkeypatch, killed):
    before = versions.current(spark, warehouse)
    want = counts(Warehouse(spark, warehouse, "tables"))

    def dies(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setitem(jobs.CLEANERS, "fact_revenue", dies)  # wave 1 is written by then
    if killed:  # nothing is cleaned up either
        monkeypatch.setattr(versions, "discard", lambda *_: None)
    runs = set(os.listdir(f"{warehouse}/data"))
    with pytest.raises(RuntimeError, match="lost"):
        jobs.etl_job(spark, SF, warehouse)
    assert versions.current(spark, warehouse) == before and len(before.tables) == 8
    assert counts(Warehouse(spark, warehouse, "tables")) == want
    assert (set(os.listdir(f"{warehouse}/data")) == runs) is not killed


def test_readers_keep_the_version_they_opened(spark, tmp_out):
    small = spark.range(3).selectExpr("concat('C', id) AS campaign_id", "'n' AS campaign_name", "'A' AS campaign_type")
    root = tmp_out + "/wh"
    versions.load(spark, small, root, "dim_campaigns")
    opened = Warehouse(spark, root, "tables")
    assert opened.campaigns.count() == 3
    second = versions.load(spark, small.limit(1), root, "dim_campaigns", "append")
    versions.load(spark, small.limit(2), root, "dim_products", "fail")
    assert opened.version.number == 1 and opened._stored("dim_campaigns").count() == 3
    now = Warehouse(spark, root, "tables")
    assert now.campaigns.count() == 4 and now.version.number == 3
    with pytest.raises(ValueError):
        versions.load(spark, small, root, "dim_campaigns", "fail")
    versions.load(spark, small.limit(2), root, "dim_campaigns", "replace")
    assert Warehouse(spark, root, "tables").campaigns.count() == 2 and now.campaigns.count() == 4
    # Two runs from one version: the later commit fails and shows nothing.
    with pytest.raises(versions.ConcurrentLoad):
        versions.commit(spark, root, second, "parquet", {"dim_campaigns": ["data/x/dim_campaigns"]})
    assert versions.prune(spark, root, keep=1) == [1, 2, 3]
    assert Warehouse(spark, root, "tables").campaigns.count() == 2 and versions.versions(spark, root) == [4]
    assert len(os.listdir(root + "/data")) >= 2  # the products of version 3 are still listed by version 4
    assert versions.read(spark, root, versions.current(spark, root), "dim_products").count() == 2


def test_partitioned_appends_read_as_one_table(spark, tmp_out):
    q = spark.createDataFrame([("Q1", "R1", "2024-01", 5), ("Q2", "R1", "2024-02", 7)], "quota_id string, rep_id string, month_year string, quota_amount int")
    q = q.withColumn("quota_amount", F.col("quota_amount").cast("decimal(18,2)"))
    versions.load(spark, q, tmp_out, "fact_quotas")
    versions.load(spark, q.where("quota_id = 'Q2'"), tmp_out, "fact_quotas", "append")
    got = Warehouse(spark, tmp_out, "tables").quotas
    assert sorted(r.month_year for r in got.collect()) == ["2024-01", "2024-02", "2024-02"]


def test_schema_follows_the_warehouse(spark, warehouse, tmp_out):
    spark.sql("CREATE DATABASE IF NOT EXISTS follow")
    spark.catalog.setCurrentDatabase("follow")
    try:
        jobs.create_schema(spark, tmp_out + "/empty")  # never written
        assert spark.table("follow.dim_reps").count() == 0
        w = Warehouse(spark, warehouse, "tables")
        views = jobs.create_views(spark, w)
        assert not set(views) & set(PROCESSED)
        jobs.create_schema(spark, warehouse)
        for name, df in w.tables().items():
            assert spark.table(f"follow.{name}").count() == df.count() > 0, name
        jobs.etl_job(spark, SF, tmp_out + "/other", fmt="csv")
        jobs.create_schema(spark, tmp_out + "/other")
        total = kpis.total_revenue(w.revenue).first()[0]
        assert kpis.total_revenue(spark.table("follow.fact_revenue")).first()[0] == total
        spark.sql("DROP TABLE follow.dim_reps")  # the table, not a view of the session
        assert not spark.catalog.tableExists("spark_catalog.follow.dim_reps")
        spark.sql("CREATE TABLE follow.dim_reps (x INT) USING parquet")
        with pytest.raises(ValueError, match="managed"):
            jobs.create_schema(spark, warehouse)
        spark.sql("DROP TABLE follow.dim_reps")
        more = w.quotas.limit(1)
        versions.load(spark, w.quotas, tmp_out + "/two", "fact_quotas")
        versions.load(spark, more, tmp_out + "/two", "fact_quotas", "append")
        root = versions.current(spark, tmp_out + "/two")
        rest = {t: [f"data/none/{t}"] for t in PROCESSED if t != "fact_quotas"}
        versions.commit(spark, tmp_out + "/two", root, "parquet", {**root.tables, **rest})
        for _ in range(2):  # and again over the view that it made
            jobs.create_schema(spark, tmp_out + "/two")
            assert spark.table("follow.fact_quotas").count() == w.quotas.count() + 1
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE follow CASCADE")


def test_every_job_runs_over_a_csv_warehouse(spark, warehouse, tmp_out):
    out = jobs.run_all(spark, SF, tmp_out + "/run", fmt="csv")
    assert {len(out[k]) for k in ("kpi", "ab", "forecast", "report")} == {6, 3, 1, 7}
    jobs.kpi_job(spark, warehouse, tmp_out + "/kpi")
    for name in landing.EXPORTS:
        a, b = (landing.read_export(spark, root, name) for root in (tmp_out + "/run/exports/kpi", tmp_out + "/kpi"))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_stored_views_serve_other_sessions_and_follow_the_tables(spark, warehouse, tmp_out):
    from quotaloom.plans.views import store_views

    spark.sql("CREATE DATABASE IF NOT EXISTS stored")
    spark.catalog.setCurrentDatabase("stored")
    try:
        jobs.create_schema(spark, tmp_out + "/empty")
        names = store_views(spark)
        assert [spark.newSession().table(n).count() for n in names] == [0, 0, 0]
        jobs.create_schema(spark, warehouse)  # the views follow
        other = spark.newSession()
        w = Warehouse(spark, warehouse, "tables")
        want = [kpis.exec_kpi_summary(w.opportunities, w.reps, w.revenue, w.quotas), kpis.pipeline_health(w.opportunities, w.reps),
                kpis.campaign_performance(w.opportunities, w.campaigns)]
        for name, df in zip(names, want, strict=True):
            got = other.table(name)
            assert got.columns == df.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())) != [], name
        assert store_views(spark) == names  # again over those that stand
        spark.sql("DROP TABLE stored.dim_reps")
        assert not spark.catalog.tableExists("spark_catalog.stored.dim_reps")
        with pytest.raises(Exception, match="dim_reps"):
            other.table(names[1]).count()
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE stored CASCADE")
