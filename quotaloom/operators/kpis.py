"""KPI queries (K1–K9) and reporting views (V1–V3).

Plan shape used throughout: facts are first aggregated by (rep_id[, month]) — a partial
plus final hash aggregation, so a rep holding a third of all rows collapses map-side —
then joined to the rep dimension (broadcast only when its estimated size allows), then
re-aggregated at the reported grain (rep *name*, region, territory: namesakes merge as
in the reference). All such rewrites are exact: the joins are N:1 on a deduplicated key.

Averages are sum/count in double over exact DECIMAL or integer sums, and rounding uses
the shared half-away-from-zero helper, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import clip, kpi_band, month_key, rnd, safe_div, weighted
from ..functions.joins import small

REP_ATTRS = ["rep_id", "rep_name", "region", "territory"]

# Output order of each result when it is exported (the reference's ORDER BY clauses).
# Query results stay unordered: a global sort is a range-partitioning job plus a stage,
# and order is only observable in the exported files, so jobs sort right before writing.
EXPORT_ORDER = {
    "win_rate": ["month_year", "-win_rate"],
    "win_rate_region_month": ["month_year", "region"],
    "win_rate_sql": ["-month_year", "-win_rate"],
    "pipeline_velocity": ["month_year", "region"],
    "pipeline_velocity_sql": ["-month_year", "-pipeline_velocity"],
    "quota_attainment": ["-month_year", "-quota_attainment"],
    "quota_attainment_sql": ["-month_year", "-quota_attainment"],
    "forecast_accuracy": ["-month_year"],
    "forecast_accuracy_sql": ["-month_year"],
    "monthly_revenue": ["month_year"],
    "mom_variance": ["month_year"],
    "mom_variance_sql": ["month_year"],
    "territory_perf": ["-total_revenue"],
    "territory_summary_fanout": ["-total_revenue"],
    "cycle_by_stage_product": ["category", "-avg_days"],
    "pq_win_rate": ["-month_date"],
    "pq_mom_flag": ["month_date"],
    "dash_funnel": ["stage_order"],
}


def for_export(name: str, df: DataFrame) -> DataFrame:
    """``df`` in its exported order (unchanged when the dataset has none)."""
    if name not in EXPORT_ORDER:
        return df
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in EXPORT_ORDER[name]])


def _reps(reps: DataFrame, *cols: str) -> DataFrame:
    return small(reps.select("rep_id", *cols))


# ── K1 win rate ──────────────────────────────────────────────

def _closed_by_rep_month(opps: DataFrame) -> DataFrame:
    closed = opps.filter((F.col("is_closed") == 1) & F.col("close_date").isNotNull())
    return (closed.groupBy("rep_id", month_key("close_date").alias("month_year"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("is_won").alias("won")))


def win_rate(opps: DataFrame, reps: DataFrame, granularity: str = "rep_month", won_name: str = "won") -> DataFrame:
    """Closed opportunities with a close date, won / closed by grain.

    granularity: 'rep_month' (rep name, region, territory, close month), 'region_month', 'overall'.
    """
    pre = _closed_by_rep_month(opps)
    grain = {"rep_month": ["rep_name", "region", "territory", "month_year"],
             "region_month": ["region", "month_year"], "overall": []}[granularity]
    attrs = [c for c in grain if c in ("rep_name", "region", "territory")]
    j = pre.join(_reps(reps, *attrs), "rep_id")
    g = j.groupBy(*grain).agg(F.sum("n").alias("total_closed"), F.sum("won").cast("bigint").alias(won_name))
    return g.withColumn("win_rate", rnd(safe_div(won_name, "total_closed"), 4))


def win_rate_sql(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """K1s: the SQL sibling (column total_won, month descending)."""
    return win_rate(opps, reps, "rep_month", won_name="total_won")


# ── K2 pipeline velocity ─────────────────────────────────────

def _region_created_month(opps: DataFrame, reps: DataFrame) -> DataFrame:
    pre = (opps.groupBy("rep_id", month_key("created_date").alias("month_year"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("deal_value").alias("sv"), F.count("deal_value").alias("cv"),
                F.sum("is_won").alias("won"), F.sum("is_closed").alias("closed"),
                F.sum("days_in_pipeline").alias("sd"), F.count("days_in_pipeline").alias("cd")))
    j = pre.join(_reps(reps, "region"), "rep_id")
    return j.groupBy("region", "month_year").agg(
        F.sum("n").alias("num_opportunities"),
        (F.sum("sv").cast("double") / F.sum("cv")).alias("avg_deal"),
        safe_div(F.sum("won"), F.sum("closed")).alias("wr"),
        (F.sum("sd").cast("double") / F.sum("cd")).alias("avg_days"),
    )


def pipeline_velocity(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """K2: by region and created month; velocity from the *rounded* parts; HAVING days > 0."""
    g = _region_created_month(opps, reps)
    g = g.select("region", "month_year", "num_opportunities",
                 rnd("avg_deal", 2).alias("avg_deal_size"), rnd("wr", 4).alias("win_rate"),
                 rnd("avg_days", 1).alias("avg_cycle_days"))
    g = g.filter(F.col("avg_cycle_days") > 0)
    v = F.col("num_opportunities") * F.col("win_rate") * F.col("avg_deal_size") / F.col("avg_cycle_days")
    return g.withColumn("pipeline_velocity", rnd(v, 2))


def pipeline_velocity_sql(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """K2s: velocity from unrounded parts, no HAVING, null when the day average is 0."""
    g = _region_created_month(opps, reps)
    v = F.col("num_opportunities") * F.col("wr") * F.col("avg_deal") / F.when(F.col("avg_days") != 0, F.col("avg_days"))
    return g.select("region", "month_year", "num_opportunities", rnd("avg_deal", 2).alias("avg_deal_size"),
                    rnd("wr", 4).alias("win_rate"), rnd("avg_days", 1).alias("avg_cycle_days"),
                    rnd(v, 2).alias("pipeline_velocity"))


# ── K3 / K4 quota and forecast vs revenue ────────────────────

def revenue_by_rep_month(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("rep_id", "month_year").agg(F.sum("revenue").alias("rev"))


def quota_attainment(quotas: DataFrame, reps: DataFrame, revenue: DataFrame, with_region: bool = True,
                     with_band: bool = True) -> DataFrame:
    """K3 (K3s with ``with_region=False, with_band=False``): quota ⋈ rep ⟕ revenue per rep-month."""
    attrs = ["rep_name", "region", "territory"] if with_region else ["rep_name", "territory"]
    q = quotas.select("rep_id", "month_year", "quota_amount").join(_reps(reps, *attrs), "rep_id")
    j = q.join(revenue_by_rep_month(revenue), ["rep_id", "month_year"], "left")
    g = j.groupBy(*attrs, "month_year", "quota_amount").agg(F.coalesce(F.sum("rev"), F.lit(0)).alias("_act"))
    out = g.select(*attrs, "month_year", F.col("_act").cast("double").alias("actual_revenue"),
                   F.col("quota_amount").cast("double").alias("quota_amount"),
                   rnd(safe_div("_act", "quota_amount"), 4).alias("quota_attainment"))
    if with_band:
        out = out.withColumn("attainment_band", kpi_band("quota_attainment"))
    return out


def forecast_accuracy(forecasts: DataFrame, reps: DataFrame, revenue: DataFrame) -> DataFrame:
    """K4: accuracy = max(0, 1 − |a − f| / a) (4 dp), mape (2 dp); null when actual = 0."""
    f = forecasts.select("rep_id", "month_year", "forecasted_rev").join(_reps(reps, "rep_name", "region"), "rep_id")
    j = f.join(revenue_by_rep_month(revenue), ["rep_id", "month_year"], "left")
    g = j.groupBy("rep_name", "region", "month_year", "forecasted_rev").agg(
        F.coalesce(F.sum("rev"), F.lit(0)).cast("double").alias("actual_revenue"))
    err = F.abs(F.col("actual_revenue") - F.col("forecasted_rev").cast("double"))
    g = g.select("rep_name", "region", "month_year", F.col("forecasted_rev").cast("double").alias("forecasted_rev"),
                 "actual_revenue", err.alias("abs_error"))
    ratio = safe_div("abs_error", "actual_revenue")
    return g.select("*", rnd(clip(F.lit(1.0) - ratio, lo=0.0), 4).alias("forecast_accuracy"),
                    rnd(ratio * F.lit(100.0), 2).alias("mape"))


def forecast_accuracy_sql(forecasts: DataFrame, reps: DataFrame, revenue: DataFrame) -> DataFrame:
    """K4s: no clip at 0 (may be negative), no mape, no region."""
    f = forecasts.select("rep_id", "month_year", "forecasted_rev").join(_reps(reps, "rep_name"), "rep_id")
    j = f.join(revenue_by_rep_month(revenue), ["rep_id", "month_year"], "left")
    g = j.groupBy("rep_name", "month_year", "forecasted_rev").agg(
        F.coalesce(F.sum("rev"), F.lit(0)).cast("double").alias("actual_revenue"))
    err = F.abs(F.col("actual_revenue") - F.col("forecasted_rev").cast("double"))
    return g.select("rep_name", "month_year", F.col("forecasted_rev").cast("double").alias("forecasted_rev"),
                    "actual_revenue",
                    rnd(F.lit(1.0) - safe_div(err, "actual_revenue"), 4).alias("forecast_accuracy"))


# ── K5 month over month ──────────────────────────────────────

def monthly_revenue(revenue: DataFrame) -> DataFrame:
    """K8: revenue per month, ordered — the series input of forecasting."""
    return revenue.groupBy("month_year").agg(F.sum("revenue").cast("double").alias("total_revenue"))


def _by_month() -> Window:
    # One row per month after aggregation: a single ordered window over a few hundred rows.
    return Window.orderBy("month_year")


def mom_variance(revenue: DataFrame) -> DataFrame:
    """K5: previous *present* month, variance, variance % (2 dp); rows with a null dropped."""
    m = revenue.groupBy("month_year").agg(F.sum("revenue").cast("double").alias("total_revenue"))
    m = m.withColumn("prev_revenue", F.lag("total_revenue").over(_by_month()))
    m = m.withColumn("variance", F.col("total_revenue") - F.col("prev_revenue"))
    m = m.withColumn("variance_pct", rnd(safe_div("variance", "prev_revenue") * F.lit(100.0), 2))
    return m.na.drop()


def mom_variance_sql(revenue: DataFrame) -> DataFrame:
    """K5s: amounts rounded to 2 dp; pct null when previous is 0; first month dropped."""
    m = revenue.groupBy("month_year").agg(F.sum("revenue").cast("double").alias("t"))
    m = m.withColumn("p", F.lag("t").over(_by_month())).filter(F.col("p").isNotNull())
    return m.select("month_year", rnd("t", 2).alias("current_revenue"), rnd("p", 2).alias("previous_revenue"),
                    rnd(F.col("t") - F.col("p"), 2).alias("revenue_variance"),
                    rnd(safe_div(F.col("t") - F.col("p"), "p") * F.lit(100.0), 2).alias("variance_pct"))


# ── K6 territory ─────────────────────────────────────────────

def territory_performance(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """K6: closed opportunities by territory.

    COUNT(DISTINCT opportunity_id) is a plain count of ids: the cleaned fact has one row
    per id (keep-first dedupe), so no distinct-aggregate expansion is needed.
    """
    won = F.col("is_won") == 1
    pre = opps.filter(F.col("is_closed") == 1).groupBy("rep_id").agg(
        F.count("opportunity_id").alias("n"), F.sum("is_won").alias("won"),
        F.sum(F.when(won, F.col("deal_value")).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("rev"),
        F.sum(F.when(won, F.col("deal_value"))).alias("wsum"), F.count(F.when(won, F.col("deal_value"))).alias("wcnt"),
        F.sum("days_in_pipeline").alias("sd"), F.count("days_in_pipeline").alias("cd"))
    j = pre.join(_reps(reps, "territory", "region"), "rep_id")
    g = j.groupBy("territory", "region").agg(
        F.sum("n").alias("total_opps"), F.sum("won").cast("bigint").alias("won_opps"),
        F.sum("rev").alias("_rev"), F.sum("wsum").alias("_ws"), F.sum("wcnt").alias("_wc"),
        F.sum("sd").alias("_sd"), F.sum("cd").alias("_cd"))
    return g.select("territory", "region", "total_opps", "won_opps",
                    rnd(safe_div("won_opps", "total_opps"), 4).alias("win_rate"),
                    rnd("_rev", 2).alias("total_revenue"),
                    rnd(safe_div("_ws", "_wc"), 2).alias("avg_deal_size"),
                    rnd(safe_div("_sd", "_cd"), 1).alias("avg_cycle_days"))


def _wide(x: str) -> Column:
    """A count or sum that a row multiplicity scales: wide enough for a hot key's product."""
    return F.col(x).cast("decimal(20,0)")


def _w(x: str) -> Column:
    """Row multiplicity of a left-joined side: its row count, or 1 when it had no rows."""
    return F.greatest(F.coalesce(F.col(x), F.lit(0)), F.lit(1))


def territory_summary_fanout(opps: DataFrame, reps: DataFrame, revenue: DataFrame) -> DataFrame:
    """K6s: rep ⟕ opportunity ⟕ revenue joined on rep only (many-to-many).

    Reproduces the inflated sums/averages exactly without materialising the pairs: each
    fact is aggregated per rep, and every sum is weighted by the other side's row count.
    """
    o = opps.groupBy("rep_id").agg(F.count(F.lit(1)).alias("o_rows"), F.count("opportunity_id").alias("o_ids"),
                                   F.sum("days_in_pipeline").alias("sd"), F.count("days_in_pipeline").alias("cd"))
    r = revenue.groupBy("rep_id").agg(F.count(F.lit(1)).alias("r_rows"), F.count("revenue_id").alias("r_ids"),
                                      F.sum("revenue").alias("sr"), F.count("revenue").alias("cr"))
    base = reps.select("rep_id", "territory", "region")
    j = base.join(o, "rep_id", "left").join(r, "rep_id", "left")
    g = j.groupBy("territory", "region").agg(
        F.coalesce(F.sum("o_ids"), F.lit(0)).alias("total_opportunities"),
        F.coalesce(F.sum("r_ids"), F.lit(0)).alias("closed_won_deals"),
        F.sum(F.col("sr") * _w("o_rows")).alias("_sr"),
        F.sum(_wide("cr") * _w("o_rows")).alias("_cr"),
        F.sum(_wide("sd") * _w("r_rows")).alias("_sd"),
        F.sum(_wide("cd") * _w("r_rows")).alias("_cd"))
    return g.select("territory", "region", "total_opportunities", "closed_won_deals",
                    rnd("_sr", 2).alias("total_revenue"), rnd(safe_div("_sr", "_cr"), 2).alias("avg_deal_size"),
                    rnd(safe_div("closed_won_deals", "total_opportunities"), 4).alias("win_rate"),
                    rnd(safe_div("_sd", "_cd"), 1).alias("avg_sales_cycle_days"))


# ── K7 cycle by stage and product category ───────────────────

def cycle_by_stage_product(opps: DataFrame, products: DataFrame) -> DataFrame:
    pre = opps.filter(F.col("is_closed") == 1).groupBy("product_id", "stage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("days_in_pipeline").alias("sd"), F.count("days_in_pipeline").alias("cd"),
        F.min("days_in_pipeline").alias("mn"), F.max("days_in_pipeline").alias("mx"))
    j = pre.join(small(products.select("product_id", "category")), "product_id")
    g = j.groupBy("category", "stage").agg(F.sum("n").alias("opportunity_count"), F.sum("sd").alias("_sd"),
                                           F.sum("cd").alias("_cd"), F.min("mn").alias("_mn"), F.max("mx").alias("_mx"))
    return g.select("category", "stage", "opportunity_count", rnd(safe_div("_sd", "_cd"), 1).alias("avg_days"),
                    rnd("_mn", 1).alias("min_days"), rnd("_mx", 1).alias("max_days"))


# ── V1 executive summary ─────────────────────────────────────

def _exec_parts(opps: DataFrame, reps: DataFrame, revenue: DataFrame, quotas: DataFrame):
    rv = revenue.groupBy("rep_id", month_key("close_date").alias("month_year")).agg(
        F.count(F.lit(1)).alias("r_rows"), F.sum("revenue").alias("sr"))
    op = opps.filter((F.col("is_closed") == 1) & F.col("close_date").isNotNull()).groupBy(
        "rep_id", month_key("close_date").alias("month_year")).agg(
        F.count(F.lit(1)).alias("o_rows"), F.count("opportunity_id").alias("o_ids"), F.sum("is_won").alias("won"),
        F.sum("days_in_pipeline").alias("sd"), F.count("days_in_pipeline").alias("cd"))
    return rv, op


def exec_kpi_summary(opps: DataFrame, reps: DataFrame, revenue: DataFrame, quotas: DataFrame) -> DataFrame:
    """V1: the view as defined, fan-out included (revenue rows × closed opportunities of the
    rep-month × quota rows), computed from per-(rep, month) aggregates and multiplicities."""
    rv, op = _exec_parts(opps, reps, revenue, quotas)
    q = quotas.groupBy("rep_id", "month_year", "quota_amount").agg(F.count(F.lit(1)).alias("q_rows"))
    j = (rv.join(_reps(reps, "region", "territory", "rep_name"), "rep_id")
         .join(op, ["rep_id", "month_year"], "left").join(q, ["rep_id", "month_year"], "left"))
    qw = _w("q_rows")
    g = j.groupBy("region", "territory", "rep_name", "month_year", "quota_amount").agg(
        F.sum(F.col("sr") * _w("o_rows") * qw).alias("_rev"),
        F.coalesce(F.sum("o_ids"), F.lit(0)).alias("total_opps"),
        F.sum(_wide("won") * F.col("r_rows") * qw).cast("bigint").alias("won_opps"),
        F.sum(_wide("sd") * F.col("r_rows") * qw).alias("_sd"),
        F.sum(_wide("cd") * F.col("r_rows") * qw).alias("_cd"))
    return g.select("region", "territory", "rep_name", "month_year",
                    F.col("_rev").cast("double").alias("actual_revenue"),
                    F.col("quota_amount").cast("double").alias("quota_amount"),
                    rnd(safe_div("_rev", "quota_amount"), 4).alias("quota_attainment"),
                    "total_opps", "won_opps", rnd(safe_div("won_opps", "total_opps"), 4).alias("win_rate"),
                    rnd(safe_div("_sd", "_cd"), 1).alias("avg_cycle_days"))


def exec_kpi_summary_corrected(opps: DataFrame, reps: DataFrame, revenue: DataFrame, quotas: DataFrame) -> DataFrame:
    """Same columns, facts aggregated before joining (no double counting); grain
    region, territory, rep name, month; quota = sum of the rep-month quotas."""
    rv, op = _exec_parts(opps, reps, revenue, quotas)
    q = quotas.groupBy("rep_id", "month_year").agg(F.sum("quota_amount").alias("quota"))
    j = (rv.join(_reps(reps, "region", "territory", "rep_name"), "rep_id")
         .join(op, ["rep_id", "month_year"], "left").join(q, ["rep_id", "month_year"], "left"))
    g = j.groupBy("region", "territory", "rep_name", "month_year").agg(
        F.sum("sr").alias("_rev"), F.sum("quota").alias("_q"), F.coalesce(F.sum("o_ids"), F.lit(0)).alias("total_opps"),
        F.sum("won").cast("bigint").alias("won_opps"), F.sum("sd").alias("_sd"), F.sum("cd").alias("_cd"))
    return g.select("region", "territory", "rep_name", "month_year",
                    F.col("_rev").cast("double").alias("actual_revenue"), F.col("_q").cast("double").alias("quota_amount"),
                    rnd(safe_div("_rev", "_q"), 4).alias("quota_attainment"), "total_opps", "won_opps",
                    rnd(safe_div("won_opps", "total_opps"), 4).alias("win_rate"),
                    rnd(safe_div("_sd", "_cd"), 1).alias("avg_cycle_days"))


# ── V2 / V3 ──────────────────────────────────────────────────

def pipeline_health(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """V2: open opportunities by rep, territory, stage."""
    pre = opps.filter(F.col("is_closed") == 0).groupBy("rep_id", "stage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("deal_value").alias("v"),
        F.sum(weighted(F.col("deal_value"), F.col("probability"))).alias("wv"),
        F.sum("days_in_pipeline").alias("sd"), F.count("days_in_pipeline").alias("cd"))
    j = pre.join(_reps(reps, "rep_name", "territory"), "rep_id")
    g = j.groupBy("rep_name", "territory", "stage").agg(
        F.sum("n").alias("opp_count"), F.sum("v").cast("double").alias("pipeline_value"),
        F.sum("wv").cast("double").alias("weighted_pipeline"), F.sum("sd").alias("_sd"), F.sum("cd").alias("_cd"))
    return g.select("rep_name", "territory", "stage", "opp_count", "pipeline_value", "weighted_pipeline",
                    rnd(safe_div("_sd", "_cd"), 1).alias("avg_age_days"))


def campaign_performance(opps: DataFrame, campaigns: DataFrame) -> DataFrame:
    """V3: closed opportunities by campaign name and type."""
    won = F.col("is_won") == 1
    pre = opps.filter(F.col("is_closed") == 1).groupBy("campaign_id").agg(
        F.count("opportunity_id").alias("n"), F.sum("is_won").alias("won"),
        F.sum("deal_value").alias("sv"), F.count("deal_value").alias("cv"),
        F.sum(F.when(won, F.col("deal_value")).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("rev"))
    j = pre.join(small(campaigns.select("campaign_id", "campaign_name", "campaign_type")), "campaign_id")
    g = j.groupBy("campaign_name", "campaign_type").agg(
        F.sum("n").alias("total_opps"), F.sum("won").cast("bigint").alias("won_opps"), F.sum("sv").alias("_sv"),
        F.sum("cv").alias("_cv"), F.sum("rev").alias("_rev"))
    return g.select("campaign_name", "campaign_type", "total_opps", "won_opps",
                    rnd(safe_div("won_opps", "total_opps"), 4).alias("win_rate"),
                    rnd(safe_div("_sv", "_cv"), 2).alias("avg_deal_value"), rnd("_rev", 2).alias("total_revenue"))


def total_revenue(revenue: DataFrame) -> DataFrame:
    """K9: grand total."""
    return revenue.agg(F.sum("revenue").cast("double").alias("total_revenue"))
