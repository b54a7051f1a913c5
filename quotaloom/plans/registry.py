"""Query registry: every operator as a ``(spark, sf_dir) -> DataFrame`` callable.

Each entry builds the star schema from the driver tables (``plans.warehouse``) and runs
one operator over the whole tables. Result sets render DATE columns as ISO text and
DECIMAL as double so that other engines read identical values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import iso_date_text, rnd
from ..functions.joins import small
from ..operators import clean, derive, experiments as ab, forecast as fc, kpis, measures as M, reports as rp
from ..session import ensure_checkpoint_dir
from ..sources import landing, sinks, testdata, versions
from ..sources.schemas import PARTITIONS, RAW_COLUMNS, RAW_FILES
from . import jobs
from .warehouse import ADAPTER_FIRST_MONTH, ADAPTER_LAST_MONTH, Warehouse, from_testdata, months_between

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Fixed parameters of the registered forecasting queries.
HOLT_ALPHA = 0.5
HOLT_BETA = 0.3
HORIZON = 3
# As-of date of the lifecycle rule on the driver tables.
LIFECYCLE_AS_OF = "2000-06-30"


def register(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return iso_date_text(fn(from_testdata(spark, sf_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def model(w: Warehouse) -> M.Model:
    return M.Model(w.opportunities, w.revenue, w.quotas, w.forecasts, w.reps, w.dates, w.products, w.campaigns)


# ── 2.2 cleansing ────────────────────────────────────────────
register("clean_reps")(lambda w: w.reps)
register("clean_opportunities")(lambda w: w.opportunities)
register("clean_revenue")(lambda w: w.revenue)
register("clean_quotas")(lambda w: w.quotas)
register("clean_forecasts")(lambda w: w.forecasts)
register("clean_products")(lambda w: w.products)
register("clean_campaigns")(lambda w: w.campaigns)
register("dim_date")(lambda w: w.dates)


@register("dq_row_counts")
def _dq_counts(w: Warehouse) -> DataFrame:
    return clean.dq_row_counts({
        "reps": (w.raw("reps"), w.reps), "opportunities": (w.raw("opportunities"), w.opportunities),
        "revenue": (w.raw("revenue"), w.revenue), "quotas": (w.raw("quotas"), w.quotas),
        "forecasts": (w.raw("forecasts"), w.forecasts), "products": (w.raw("products"), w.products),
        "campaigns": (w.raw("campaigns"), w.campaigns)})


register("dq_rule_counts")(lambda w: clean.dq_rule_counts(
    {n: w.raw(n) for n in ("reps", "opportunities", "revenue", "quotas", "forecasts", "products", "campaigns")},
    unique=("revenue", "quotas", "forecasts")))


@register("dq_constraints")
def _dq_constraints(w: Warehouse) -> DataFrame:
    return clean.dq_constraints(w.tables())


@register("dq_offenders")
def _dq_offenders(w: Warehouse) -> DataFrame:
    judged = clean.split_offenders(w.raw("opportunities").drop("_seq"), "fact_opportunities",
                                   {"dim_reps": w.reps, "dim_products": w.products, "dim_campaigns": w.campaigns})
    return judged.filter(F.size("violates") > 0).select("opportunity_id", F.array_join("violates", ",").alias("violates"))


# ── 2.3 derivations ──────────────────────────────────────────
register("derive_bookings")(lambda w: derive.derive_bookings(w.opportunities))
register("booking_numbers")(lambda w: derive.number_bookings(derive.derive_bookings(w.opportunities)))
register("quota_spine")(lambda w: w.raw("quotas"))
register("forecast_baseline")(lambda w: derive.forecast_baseline(w.revenue))


@register("opp_lifecycle")
def _lifecycle(w: Warehouse) -> DataFrame:
    li = testdata.table(w.spark, w.source, "lineitem")
    od = testdata.table(w.spark, w.source, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    base = j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("opportunity_id"),
        F.col("l_suppkey").alias("rep_id"), F.col("o_orderdate").cast("date").alias("created_date"),
        F.col("l_shipdate").cast("date").alias("planned_close_date"),
        (F.col("l_returnflag") == "A").cast("int").alias("wins"),
        F.when(F.col("l_returnflag") == "N", "Prospecting").when(F.col("l_returnflag") == "R", "Proposal")
        .otherwise("Negotiation").alias("open_stage"),
        F.round(F.col("l_discount") * 1000.0).alias("open_probability"))
    return derive.opp_lifecycle(base, LIFECYCLE_AS_OF)


@register("source_profile")
def _profile(w: Warehouse) -> DataFrame:
    return derive.source_profile(w.raw("reps"), w.raw("opportunities"), w.raw("revenue"), w.raw("quotas"),
                                 w.raw("forecasts"), {"products": w.raw("products"), "campaigns": w.raw("campaigns")})


# ── 2.4 KPIs ─────────────────────────────────────────────────
register("win_rate_rep_month")(lambda w: kpis.win_rate(w.opportunities, w.reps, "rep_month"))
register("win_rate_region_month")(lambda w: kpis.win_rate(w.opportunities, w.reps, "region_month"))
register("win_rate_overall")(lambda w: kpis.win_rate(w.opportunities, w.reps, "overall"))
register("win_rate_sql")(lambda w: kpis.win_rate_sql(w.opportunities, w.reps))
register("pipeline_velocity")(lambda w: kpis.pipeline_velocity(w.opportunities, w.reps))
register("pipeline_velocity_sql")(lambda w: kpis.pipeline_velocity_sql(w.opportunities, w.reps))
register("quota_attainment")(lambda w: kpis.quota_attainment(w.quotas, w.reps, w.revenue))
register("quota_attainment_sql")(lambda w: kpis.quota_attainment(w.quotas, w.reps, w.revenue, False, False))
register("forecast_accuracy")(lambda w: kpis.forecast_accuracy(w.forecasts, w.reps, w.revenue))
register("forecast_accuracy_sql")(lambda w: kpis.forecast_accuracy_sql(w.forecasts, w.reps, w.revenue))
register("mom_variance")(lambda w: kpis.mom_variance(w.revenue))
register("mom_variance_sql")(lambda w: kpis.mom_variance_sql(w.revenue))
register("territory_performance")(lambda w: kpis.territory_performance(w.opportunities, w.reps))
register("territory_summary_fanout")(lambda w: kpis.territory_summary_fanout(w.opportunities, w.reps, w.revenue))
register("cycle_by_stage_product")(lambda w: kpis.cycle_by_stage_product(w.opportunities, w.products))
register("exec_kpi_summary")(lambda w: kpis.exec_kpi_summary(w.opportunities, w.reps, w.revenue, w.quotas))
register("exec_kpi_summary_corrected")(
    lambda w: kpis.exec_kpi_summary_corrected(w.opportunities, w.reps, w.revenue, w.quotas))
register("pipeline_health")(lambda w: kpis.pipeline_health(w.opportunities, w.reps))
register("campaign_performance")(lambda w: kpis.campaign_performance(w.opportunities, w.campaigns))
register("monthly_revenue")(lambda w: kpis.monthly_revenue(w.revenue))
register("total_revenue")(lambda w: kpis.total_revenue(w.revenue))


# ── 2.5 experiments ──────────────────────────────────────────
def _abd(w: Warehouse) -> DataFrame:
    return ab.ab_dataset(w.opportunities, w.campaigns)


def _abm(w: Warehouse, **by) -> DataFrame:
    return ab.campaign_moments(w.opportunities, w.campaigns, by=by)


register("ab_dataset")(_abd)
register("ab_welch_ttest")(lambda w: ab.ab_welch_ttest(_abm(w)))
register("ab_welch_ttest_p")(lambda w: ab.ab_welch_ttest_p(_abm(w)))
register("ab_chi_square")(lambda w: ab.ab_chi_square(_abm(w)))
register("ab_chi_square_p")(lambda w: ab.ab_chi_square_p(_abm(w)))
register("ab_effect_size")(lambda w: ab.ab_effect_size(_abm(w)))
register("campaign_summary")(lambda w: ab.campaign_summary(_abd(w)))
register("ab_report")(lambda w: ab.ab_report(_abm(w)))


@register("ab_tests_grouped")
def _ab_grouped(w: Warehouse) -> DataFrame:
    return ab.ab_tests_grouped(_abm(w, region=(w.reps, "rep_id")), ["region"])


@register("ab_tests_by_category")
def _ab_by_category(w: Warehouse) -> DataFrame:
    return ab.ab_tests_grouped(_abm(w, category=(w.products, "product_id")), ["category"])


# ── 2.6 forecasting ──────────────────────────────────────────
def region_monthly(w: Warehouse) -> DataFrame:
    """Revenue per (region, month): aggregated per (rep, month) before the rep join."""
    pre = kpis.revenue_by_rep_month(w.revenue)
    j = pre.join(small(w.reps.select("rep_id", "region")), "rep_id")
    return j.groupBy("region", "month_year").agg(F.sum("rev").alias("revenue"))


def _holt(w: Warehouse) -> DataFrame:
    return fc.holt_fixed(region_monthly(w), ["region"], "revenue", HOLT_ALPHA, HOLT_BETA)


@register("holt_fixed")
def _holt_fixed(w: Warehouse) -> DataFrame:
    h = _holt(w)
    return h.select("region", "month_year", "y", *[rnd(c, 2).alias(c) for c in ("fitted", "level", "trend")])


register("holt_forecast")(lambda w: fc.holt_forecast(region_monthly(w), ["region"], "revenue", HORIZON))
register("holt_forecast_total")(lambda w: fc.holt_forecast(w.revenue, [], "revenue", HORIZON))
register("holt_forecast_rep")(
    lambda w: fc.holt_forecast(kpis.revenue_by_rep_month(w.revenue), ["rep_id"], "rev", HORIZON))


def monthly_by(w: Warehouse, dim: DataFrame, key: str, attribute: str) -> DataFrame:
    """Revenue per (attribute, month) of a dimension: aggregated per (key, month) before its join."""
    pre = w.revenue.groupBy(key, "month_year").agg(F.sum("revenue").alias("rev"))
    j = pre.join(small(dim.select(key, attribute)), key)
    return j.groupBy(attribute, "month_year").agg(F.sum("rev").alias("revenue"))


register("holt_forecast_territory")(
    lambda w: fc.holt_forecast(monthly_by(w, w.reps, "rep_id", "territory"), ["territory"], "revenue", HORIZON))
register("holt_forecast_category")(
    lambda w: fc.holt_forecast(monthly_by(w, w.products, "product_id", "category"), ["category"], "revenue", HORIZON))
register("forecast_metrics")(lambda w: fc.forecast_metrics(_holt(w), ["region"], HOLT_ALPHA))
register("forecast_horizon")(lambda w: fc.forecast_horizon(_holt(w), ["region"], HORIZON))
register("forecast_chart_data")(lambda w: fc.forecast_chart_data(_holt(w), ["region"], HORIZON))


# ── 2.7 measures ─────────────────────────────────────────────
def _measure(name: str, grain: list[str]):
    register(f"m_{name}")(lambda w: M.evaluate(model(w), grain, [name]))


_measure("total_revenue", ["region", "month_year"])
_measure("win_rate", ["region"])
_measure("quota_attainment", ["region", "month_year"])
_measure("pipeline_velocity", ["region"])
_measure("forecast_accuracy", ["region", "month_year"])
_measure("avg_sales_cycle_days", ["territory"])
_measure("weighted_pipeline", ["territory"])
_measure("revenue_vs_quota", ["region", "month_year"])
_measure("attainment_band", ["rep_name"])
_measure("closed_won_count", ["region"])
_measure("open_pipeline_count", ["region"])
_measure("attainment_color", ["territory"])
register("m_mom_variance_pct")(lambda w: M.mom_variance_pct(model(w)))
register("m_running_total_revenue")(lambda w: M.running_total_revenue(model(w), ["region"]))
register("m_by_campaign_type")(
    lambda w: M.evaluate(model(w), ["campaign_type"], ["win_rate", "pipeline_velocity", "closed_won_count"]))
register("m_by_category_stage")(
    lambda w: M.evaluate(model(w), ["category", "stage"], ["avg_sales_cycle_days", "open_pipeline_count"]))
register("m_region_campaign_mix")(
    lambda w: M.evaluate(model(w), ["region", "campaign_type"], ["win_rate", "total_revenue", "quota_attainment"]))
register("m_mom_variance_pct_daily")(lambda w: M.mom_variance_pct_daily(model(w)))
register("m_running_total_revenue_daily")(lambda w: M.running_total_revenue_daily(model(w)))


# ── 2.8 dashboard / report datasets ──────────────────────────
def _k1(w):
    return kpis.win_rate(w.opportunities, w.reps, "rep_month")


def _k3(w):
    return kpis.quota_attainment(w.quotas, w.reps, w.revenue)


def _k4(w):
    return kpis.forecast_accuracy(w.forecasts, w.reps, w.revenue)


def _k5(w):
    return kpis.mom_variance(w.revenue)


def _k6(w):
    return kpis.territory_performance(w.opportunities, w.reps)


register("pq_win_rate")(lambda w: rp.pq_win_rate(_k1(w)))
register("pq_mom_flag")(lambda w: rp.pq_mom_flag(_k5(w)))
register("pq_quota_band")(lambda w: rp.pq_quota_band(_k3(w)))
register("pq_dim_date")(lambda w: rp.pq_dim_date(w.dates))
register("pq_revenue_with_rep")(lambda w: rp.pq_revenue_with_rep(w.revenue, w.reps))
register("dash_funnel")(lambda w: rp.dash_funnel(w.opportunities))
register("dash_deal_scatter")(lambda w: rp.dash_deal_scatter(w.opportunities, w.reps))
register("dash_open_by_territory")(lambda w: rp.dash_open_by_territory(model(w)))
register("dash_region_matrix")(lambda w: rp.dash_region_matrix(w.opportunities, w.revenue, w.reps))
register("dash_top10_reps")(lambda w: rp.dash_top10_reps(w.revenue, w.reps))
register("dash_attainment_heatmap")(lambda w: rp.dash_attainment_heatmap(model(w)))
register("dash_attainment_heatmap_wide")(
    lambda w: rp.dash_attainment_heatmap_wide(model(w), months_between(ADAPTER_FIRST_MONTH, ADAPTER_LAST_MONTH)))
register("dash_win_by_campaign_type")(lambda w: rp.dash_win_by_campaign_type(w.opportunities, w.campaigns))
register("dash_deal_by_campaign")(lambda w: rp.dash_deal_by_campaign(w.opportunities, w.campaigns))
register("dash_exec_cards")(lambda w: rp.dash_exec_cards(model(w)))
register("dash_rep_attainment_bar")(lambda w: rp.dash_rep_attainment_bar(model(w)))
register("dash_revenue_trend")(lambda w: rp.dash_revenue_trend(model(w)))
register("report_summary")(lambda w: rp.report_summary(_k1(w), _k3(w), _k4(w), w.revenue))
register("report_revenue_12m")(lambda w: rp.report_revenue_12m(_k5(w)))
register("report_winrate_12m")(lambda w: rp.report_winrate_12m(_k1(w)))
register("report_territory_top8")(lambda w: rp.report_territory_top8(_k6(w)))
register("report_top_performer")(lambda w: rp.report_top_performer(_k1(w)))
register("report_cards")(lambda w: rp.report_cards(_k1(w), _k3(w), _k6(w), w.revenue))
register("report_findings")(lambda w: rp.report_findings(_k5(w), _k1(w), _k3(w), _k4(w), _k6(w)))


# ── 2.1 files and views: written, then read back ─────────────
def _scratch(w: Warehouse) -> str:
    return f"{ensure_checkpoint_dir(w.spark).rstrip('/')}/files-{uuid.uuid4().hex}"


def _view(name: str) -> Callable[[Warehouse], DataFrame]:
    def run(w: Warehouse) -> DataFrame:
        """IO7 and IO8: the reporting view, created and read as SQL; the session's views go again once the query is analysed."""
        views = jobs.create_views(w.spark, w)
        try:
            return jobs.query(w.spark, f"SELECT * FROM vw_{name}")
        finally:
            for v in views:
                w.spark.catalog.dropTempView(v)
    return run


for _name in ("exec_kpi_summary", "pipeline_health", "campaign_performance"):
    register(f"view_{_name}")(_view(_name))


@register("io_extract_rows")
def _io_extract_rows(w: Warehouse) -> DataFrame:
    """IO1 and IO2: the seven extracts written as CSV, landed again, and counted."""
    folder = _scratch(w)
    jobs.extract_job(w.spark, w.source, folder)
    out = None
    for name in RAW_FILES:
        n = landing.read_extract(w.spark, folder, name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("label"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


@register("io_stored_revenue")
def _io_stored_revenue(w: Warehouse) -> DataFrame:
    """IO3 and IO4: the revenue table written partitioned by month and read by name."""
    folder = _scratch(w)
    sinks.write_table(w.revenue, f"{folder}/fact_revenue", "replace", "parquet", PARTITIONS["fact_revenue"])
    return Warehouse(w.spark, folder, "tables").revenue.select(*w.revenue.columns)


@register("io_typed_export")
def _io_typed_export(w: Warehouse) -> DataFrame:
    """IO9 and IO13: a KPI exported as CSV and read back with its types."""
    folder = _scratch(w)
    sinks.publish({"quota_attainment": kpis.quota_attainment(w.quotas, w.reps, w.revenue)}, folder, "csv")
    return landing.read_export(w.spark, folder, "quota_attainment")


#: What the file queries add up per table or export: a column whose sum shows lost, doubled or shifted values.
STORED_SUMS = {
    "dim_reps": "length(rep_name)", "dim_products": "unit_price", "dim_campaigns": "length(campaign_name)", "dim_date": "day_of_week",
    "fact_opportunities": "deal_value", "fact_revenue": "revenue", "fact_quotas": "quota_amount", "fact_forecasts": "forecasted_rev"}
EXPORT_SUMS = {
    "win_rate": "won", "pipeline_velocity": "num_opportunities", "quota_attainment": "quota_amount", "forecast_accuracy": "forecasted_rev",
    "mom_variance": "total_revenue", "territory_perf": "total_opps"}


def _summed(parts: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(label, n_rows, total) of each frame; amounts add up exactly."""
    out = None
    for label, (df, value) in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.expr(f"CAST({value} AS DECIMAL(28,2))")).cast("double").alias("total"))
        row = row.select(F.lit(label).alias("label"), "n_rows", "total")
        out = row if out is None else out.unionByName(row)
    return out


@register("io_refreshed_tables")
def _io_refreshed_tables(w: Warehouse) -> DataFrame:
    """IO3, IO4 and IO14: the eight tables of a committed refresh, read by name."""
    folder = _scratch(w)
    jobs.etl_job(w.spark, w.source, folder)
    tables = Warehouse(w.spark, folder, "tables").tables()
    return _summed({t: (df, STORED_SUMS[t]) for t, df in tables.items()})


@register("io_load_modes")
def _io_load_modes(w: Warehouse) -> DataFrame:
    """IO5: the revenue table loaded, its closing months from 1995 on appended, and the products replaced by the dear ones."""
    folder = _scratch(w)
    first = versions.load(w.spark, w.revenue, folder, "fact_revenue", "fail")
    loaded = versions.read(w.spark, folder, first, "fact_revenue").select(*w.revenue.columns)  # not computed again from the lines
    versions.load(w.spark, loaded.where("month_year >= '1995-01'"), folder, "fact_revenue", "append")
    versions.load(w.spark, w.products, folder, "dim_products")
    versions.load(w.spark, w.products.where("unit_price >= 1500"), folder, "dim_products", "replace")
    now = Warehouse(w.spark, folder, "tables")
    return _summed({"fact_revenue": (now.revenue, "revenue"), "dim_products": (now.products, "unit_price")})


@register("io_typed_exports")
def _io_typed_exports(w: Warehouse) -> DataFrame:
    """IO9, IO13 and IO15: the six exported KPIs of a written warehouse, read back with their types."""
    folder = _scratch(w)
    jobs.etl_job(w.spark, w.source, f"{folder}/wh")
    jobs.kpi_job(w.spark, f"{folder}/wh", f"{folder}/kpi")
    return _summed({n: (landing.read_export(w.spark, f"{folder}/kpi", n), v) for n, v in EXPORT_SUMS.items()})


@register("io_landing_rejects")
def _io_landing_rejects(w: Warehouse) -> DataFrame:
    """IO1 and TR9: a product extract whose names hold line breaks; of every seven ids one record has a field less and one a
    field more. Records in = landed + rejected."""
    folder = _scratch(w)
    rows = w.raw("products").select([F.col(c).cast("string").alias(c) for c in RAW_COLUMNS["products"]])
    q = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.coalesce(c, F.lit("")), '"', '""'), F.lit('"'))
    fields = [q(F.regexp_replace(c, " ", "\n") if c == "product_name" else F.col(c)) for c in rows.columns]
    size = F.pmod(F.col("product_id").cast("long"), F.lit(7))
    line = F.when(size == 0, F.concat_ws(",", *fields[:-1])).when(size == 1, F.concat_ws(",", *fields, F.lit("9"))).otherwise(F.concat_ws(",", *fields))
    head = w.spark.createDataFrame([(",".join(rows.columns),)], "value string")
    # Every part file starts with the header, as an extract does.
    parts = rows.select(line.alias("value")).repartition(4)
    parts.mapInArrow(_with_header(",".join(rows.columns)), head.schema).write.text(f"{folder}/products.csv")
    records = landing.read_records(w.spark, folder, "products", f"{folder}/products.csv")
    return records.agg(
        F.count(F.lit(1)).alias("n_records"), F.count(landing.REJECTED).alias("n_rejected"),
        F.sum(F.when(F.col(landing.REJECTED).isNull(), F.length("product_name"))).alias("name_chars"),
        F.sum(F.when(F.col(landing.REJECTED).isNull(), F.col("unit_price").cast("decimal(18,2)"))).cast("double").alias("prices"))


def _with_header(header: str):
    def run(batches):
        import pyarrow as pa
        first = True
        for b in batches:
            if first and b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([header], b.schema.field(0).type)], schema=b.schema)
                first = False
            yield b
    return run
