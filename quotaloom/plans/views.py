"""IO7: the three reporting views stored in the catalog, as SQL text over its tables.

A stored view names its tables in full, so it serves every session that shares the catalog and follows
``create_schema`` when that declares the tables at a newer version. As in ``operators.kpis``, facts are summed per key
before they meet a dimension or each other; the executive view scales these sums by the row counts of the other side.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _rounded(value: str, digits: int) -> str:
    """Half away from zero on the scaled double, as ``exprs.rnd``."""
    x, p = f"CAST({value} AS DOUBLE)", f"{10 ** digits}D"
    return f"CASE WHEN abs({x}) * {p} < {2 ** 53}D THEN signum({x}) * floor(abs({x}) * {p} + 0.5D) / {p} ELSE {x} END"


def _ratio(num: str, den: str, digits: int) -> str:
    return _rounded(f"CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0D)", digits)


def _times(value: str) -> str:
    """Sum of a count or sum, once for each revenue and quota row of its rep and month."""
    return f"sum(CAST({value} AS DECIMAL(20,0)) * r_rows * greatest(coalesce(q_rows, 0), 1))"


def exec_kpi_summary(db: str) -> str:
    return f"""
WITH booked AS (
  SELECT rep_id, date_format(close_date, 'yyyy-MM') AS month_year, count(*) AS r_rows, sum(revenue) AS revenue
  FROM {db}.fact_revenue GROUP BY 1, 2),
closed AS (
  SELECT rep_id, date_format(close_date, 'yyyy-MM') AS month_year, count(*) AS o_rows, count(opportunity_id) AS ids,
         sum(is_won) AS won, sum(days_in_pipeline) AS days, count(days_in_pipeline) AS with_days
  FROM {db}.fact_opportunities WHERE is_closed = 1 AND close_date IS NOT NULL GROUP BY 1, 2),
quota AS (
  SELECT rep_id, month_year, quota_amount, count(*) AS q_rows FROM {db}.fact_quotas GROUP BY 1, 2, 3),
summed AS (
  SELECT region, territory, rep_name, month_year, quota_amount,
         sum(revenue * greatest(coalesce(o_rows, 0), 1) * greatest(coalesce(q_rows, 0), 1)) AS revenue,
         coalesce(sum(ids), 0) AS ids, CAST({_times('won')} AS BIGINT) AS won,
         {_times('days')} AS days, {_times('with_days')} AS with_days
  FROM booked JOIN {db}.dim_reps USING (rep_id) LEFT JOIN closed USING (rep_id, month_year) LEFT JOIN quota USING (rep_id, month_year)
  GROUP BY 1, 2, 3, 4, 5)
SELECT region, territory, rep_name, month_year, CAST(revenue AS DOUBLE) AS actual_revenue, CAST(quota_amount AS DOUBLE) AS quota_amount,
       {_ratio('revenue', 'quota_amount', 4)} AS quota_attainment, ids AS total_opps, won AS won_opps,
       {_ratio('won', 'ids', 4)} AS win_rate, {_ratio('days', 'with_days', 1)} AS avg_cycle_days
FROM summed"""


def pipeline_health(db: str) -> str:
    return f"""
WITH still_open AS (
  SELECT rep_id, stage, count(*) AS n, sum(deal_value) AS amount,
         sum(CAST(deal_value AS DECIMAL(18,2)) * CAST(probability AS DECIMAL(13,10)) * CAST(0.01 AS DECIMAL(3,2))) AS expected,
         sum(days_in_pipeline) AS days, count(days_in_pipeline) AS with_days
  FROM {db}.fact_opportunities WHERE is_closed = 0 GROUP BY 1, 2)
SELECT rep_name, territory, stage, sum(n) AS opp_count, CAST(sum(amount) AS DOUBLE) AS pipeline_value,
       CAST(sum(expected) AS DOUBLE) AS weighted_pipeline, {_ratio('sum(days)', 'sum(with_days)', 1)} AS avg_age_days
FROM still_open JOIN {db}.dim_reps USING (rep_id) GROUP BY 1, 2, 3"""


def campaign_performance(db: str) -> str:
    return f"""
WITH closed AS (
  SELECT campaign_id, count(opportunity_id) AS ids, sum(is_won) AS won, sum(deal_value) AS amount, count(deal_value) AS with_amount,
         sum(CASE WHEN is_won = 1 THEN deal_value ELSE CAST(0 AS DECIMAL(18,2)) END) AS revenue
  FROM {db}.fact_opportunities WHERE is_closed = 1 GROUP BY 1)
SELECT campaign_name, campaign_type, sum(ids) AS total_opps, CAST(sum(won) AS BIGINT) AS won_opps,
       {_ratio('sum(won)', 'sum(ids)', 4)} AS win_rate, {_ratio('sum(amount)', 'sum(with_amount)', 2)} AS avg_deal_value,
       {_rounded('sum(revenue)', 2)} AS total_revenue
FROM closed JOIN {db}.dim_campaigns USING (campaign_id) GROUP BY 1, 2"""


VIEWS = {"vw_exec_kpi_summary": exec_kpi_summary, "vw_pipeline_health": pipeline_health,
         "vw_campaign_performance": campaign_performance}


def store_views(spark: SparkSession) -> list[str]:
    """Store the views in the current database, over the tables that ``create_schema`` declared there; returns their full names.

    A stored view of the same name is replaced; a table of that name makes Spark refuse. They outlive the session, and
    dropping a table leaves its views, which then fail until the table is declared again. A session that has read a table keeps
    the place it found: it needs REFRESH TABLE to see the table declared anew, as for any catalog table.
    """
    db = f"spark_catalog.`{spark.catalog.currentDatabase()}`"
    for name, text in VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {text(db)}")
    return [f"{db}.{name}" for name in VIEWS]
