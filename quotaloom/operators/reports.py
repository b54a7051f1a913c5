"""Dashboard, Power-Query and report datasets.

All are compositions over the KPI results or the star schema. "Last 12 months" and
"top N" are the datasets' own definitions (a limit that is the feature), always with a
named tie-break; their few rows are put in display order within one partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import VALID_STAGES, dax_band, divide_or, month_start, rnd, safe_div
from ..functions.joins import small
from ..functions.text import py_format
from . import measures as M

# ── Power Query datasets ─────────────────────────────────────


def pq_win_rate(win_rate: DataFrame) -> DataFrame:
    """Win-rate export + percent + first day of month, month descending."""
    return win_rate.select("*", (F.col("win_rate") * F.lit(100.0)).alias("win_rate_pct"),
                           month_start("month_year").alias("month_date"))


def pq_mom_flag(mom: DataFrame) -> DataFrame:
    """Month-over-month export + month date + direction (variance ≥ 0 → Positive)."""
    return mom.select("*", month_start("month_year").alias("month_date"),
                      F.when(F.col("variance") >= 0, "Positive").otherwise("Negative").alias("variance_direction"))


def pq_quota_band(quota: DataFrame) -> DataFrame:
    """Quota-attainment export + dashboard (left-closed) band + month date."""
    return quota.select("*", dax_band("quota_attainment").alias("dashboard_band"),
                        month_start("month_year").alias("month_date"))


def pq_dim_date(dates: DataFrame) -> DataFrame:
    """Alternate date dimension. Week of year with weeks starting Monday and week 1
    containing 1 January; day of week Monday = 0; 'MM/YYYY' month label."""
    d = F.to_date("date_id")
    jan1 = F.make_date(F.year(d), F.lit(1), F.lit(1))
    week = F.floor((F.dayofyear(d) - 1 + F.weekday(jan1)) / 7).cast("int") + 1
    return dates.select(d.alias("date"), "year", "quarter", "month", "month_name", week.alias("week_of_year"),
                        "day_of_week", (F.col("day_of_week") < 5).alias("is_weekday"),
                        F.concat(F.lpad(F.col("month").cast("string"), 2, "0"), F.lit("/"),
                                 F.col("year").cast("string")).alias("month_year_label"))


def pq_revenue_with_rep(revenue: DataFrame, reps: DataFrame) -> DataFrame:
    """P5: revenue ⟕ reps (rep name, region, territory); unmatched revenue kept."""
    return revenue.join(small(reps.select("rep_id", "rep_name", "region", "territory")), "rep_id", "left")


# ── dashboard visuals ────────────────────────────────────────


def dash_funnel(opps: DataFrame) -> DataFrame:
    """Opportunities by stage, with the funnel position of the stage."""
    order = F.array_position(F.array(*[F.lit(s) for s in VALID_STAGES]), F.col("stage")).cast("int")
    g = opps.groupBy("stage").agg(F.count(F.lit(1)).alias("opp_count"))
    return g.select("stage", order.alias("stage_order"), "opp_count")


def dash_deal_scatter(opps: DataFrame, reps: DataFrame) -> DataFrame:
    """One point per opportunity: rep, deal value, days in pipeline."""
    return opps.select("opportunity_id", "rep_id", F.col("deal_value").cast("double").alias("deal_value"),
                       "days_in_pipeline").join(small(reps.select("rep_id", "rep_name")), "rep_id").drop("rep_id")


def dash_open_by_territory(model: M.Model) -> DataFrame:
    """D3: open pipeline by territory: count and weighted value."""
    return M.evaluate(model, ["territory"], ["open_pipeline_count", "weighted_pipeline"])


def dash_region_matrix(opps: DataFrame, revenue: DataFrame, reps: DataFrame) -> DataFrame:
    """Revenue and win rate by region and territory with subtotals (rollup)."""
    r = revenue.groupBy("rep_id").agg(F.sum("revenue").alias("rev"))
    o = opps.groupBy("rep_id").agg(F.count(F.when(F.col("is_won") == 1, 1)).alias("won"),
                                   F.count(F.when(F.col("is_closed") == 1, 1)).alias("closed"))
    j = r.join(o, "rep_id", "full_outer").join(small(reps.select("rep_id", "region", "territory")), "rep_id")
    g = j.rollup("region", "territory").agg(
        F.sum("rev").cast("double").alias("total_revenue"), F.sum("won").alias("won"), F.sum("closed").alias("closed"),
        F.grouping_id().cast("int").alias("level"))
    return g.select("region", "territory", "level", "total_revenue", "won", "closed",
                    divide_or("won", "closed", 0.0).alias("win_rate"))


def dash_top10_reps(revenue: DataFrame, reps: DataFrame, n: int = 10) -> DataFrame:
    """The n reps with the most revenue (ties: lower rep id first)."""
    r = revenue.groupBy("rep_id").agg(F.sum("revenue").cast("double").alias("total_revenue"))
    top = r.orderBy(F.col("total_revenue").desc(), F.col("rep_id").asc()).limit(n)
    return top.join(small(reps.select("rep_id", "rep_name")), "rep_id", "left").select(
        "rep_id", "rep_name", "total_revenue")


def dash_attainment_heatmap(model: M.Model) -> DataFrame:
    """Quota attainment rep × month (long form)."""
    return M.evaluate(model, ["rep_name", "month_year"], ["quota_attainment"])


def dash_attainment_heatmap_wide(model: M.Model, months: Sequence[str]) -> DataFrame:
    """D6 as the matrix visual shows it: one row per rep, one column per month that ``months``
    names; each cell holds one value, so ``first`` is exact. With the months given, building the
    plan runs no job."""
    long = M.evaluate(model, ["rep_name", "month_year"], ["quota_attainment"])
    return long.groupBy("rep_name").pivot("month_year", list(months)).agg(F.first("quota_attainment"))


def dash_win_by_campaign_type(opps: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Win rate by campaign type (A vs B)."""
    c = small(campaigns.select("campaign_id", "campaign_type"))
    pre = opps.groupBy("campaign_id").agg(F.count(F.when(F.col("is_won") == 1, 1)).alias("w"),
                                          F.count(F.when(F.col("is_closed") == 1, 1)).alias("c"))
    g = pre.join(c, "campaign_id").groupBy("campaign_type").agg(F.sum("w").alias("won"), F.sum("c").alias("closed"))
    return g.select("campaign_type", "won", "closed", divide_or("won", "closed", 0.0).alias("win_rate"))


def dash_deal_by_campaign(opps: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Average deal value by campaign."""
    pre = opps.groupBy("campaign_id").agg(F.sum("deal_value").alias("s"), F.count("deal_value").alias("n"))
    g = pre.join(small(campaigns.select("campaign_id", "campaign_name")), "campaign_id").groupBy("campaign_name").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"))
    return g.select("campaign_name", F.col("n").alias("opp_count"), safe_div("s", "n").alias("avg_deal_value"))


def dash_exec_cards(model: M.Model) -> DataFrame:
    """Total revenue, win rate, quota attainment, average sales cycle (whole model)."""
    return M.evaluate(model, [], ["total_revenue", "win_rate", "quota_attainment", "avg_sales_cycle_days"])


def dash_rep_attainment_bar(model: M.Model) -> DataFrame:
    """Attainment by rep with band and colour."""
    return M.evaluate(model, ["rep_name"], ["total_revenue", "quota_attainment", "attainment_band",
                                            "attainment_color"])


def dash_revenue_trend(model: M.Model) -> DataFrame:
    """Monthly revenue with month-over-month variance % (calendar months)."""
    return M.mom_variance_pct(model)


# ── report datasets ──────────────────────────────────────────


def report_summary(win_rate: DataFrame, quota: DataFrame, accuracy: DataFrame, revenue: DataFrame) -> DataFrame:
    """Five KPI rows: total revenue, mean of rep-month win rates, mean attainment,
    mean forecast accuracy, total won deals — numeric value and display text."""
    tr = revenue.agg(F.sum("revenue").cast("double").alias("v"))
    wr = win_rate.agg(F.avg("win_rate").alias("v"), F.sum("won").alias("won"))
    qa = quota.agg(F.avg("quota_attainment").alias("v"))
    fa = accuracy.agg(F.avg("forecast_accuracy").alias("v"))
    pct = lambda c: py_format("{0:.1%}", c)
    rows = [  # fixed values: the labels and display formats
        tr.select(F.lit(1).alias("pos"), F.lit("Total Revenue").alias("kpi"), rnd("v", 6).alias("value"),
                  py_format("${0:,.0f}", F.col("v")).alias("display")),
        wr.select(F.lit(2).alias("pos"), F.lit("Avg Win Rate").alias("kpi"), rnd("v", 6).alias("value"),
                  pct(F.col("v")).alias("display")),
        qa.select(F.lit(3).alias("pos"), F.lit("Avg Quota Attainment").alias("kpi"), rnd("v", 6).alias("value"),
                  pct(F.col("v")).alias("display")),
        fa.select(F.lit(4).alias("pos"), F.lit("Avg Forecast Accuracy").alias("kpi"), rnd("v", 6).alias("value"),
                  pct(F.col("v")).alias("display")),
        wr.select(F.lit(5).alias("pos"), F.lit("Total Closed Deals").alias("kpi"),
                  F.col("won").cast("double").alias("value"), F.col("won").cast("string").alias("display")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def report_revenue_12m(mom: DataFrame) -> DataFrame:
    """R2: the last 12 months of the MoM table in $M, with the bar colour flag."""
    last = mom.orderBy(F.col("month_year").desc()).limit(12)
    return last.select("month_year", (F.col("total_revenue") / F.lit(1e6)).alias("revenue_musd"),
                       (F.col("variance") >= 0).alias("positive")).coalesce(1).sortWithinPartitions("month_year")


def report_winrate_12m(win_rate: DataFrame) -> DataFrame:
    """Mean of rep win rates per month, last 12 months, plus the mean of those 12."""
    m = win_rate.groupBy("month_year").agg(F.avg("win_rate").alias("avg_win_rate"))
    last = m.orderBy(F.col("month_year").desc()).limit(12)
    return last.select("month_year", rnd("avg_win_rate", 6).alias("avg_win_rate"),
                       rnd(F.avg("avg_win_rate").over(Window.partitionBy()), 6).alias("avg_of_period")
                       ).coalesce(1).sortWithinPartitions("month_year")


def report_territory_top8(territory: DataFrame) -> DataFrame:
    """The 8 territories with the most revenue, ascending, in $M (ties: name)."""
    top = territory.orderBy(F.col("total_revenue").desc(), F.col("territory").asc()).limit(8)
    return top.select("territory", (F.col("total_revenue") / F.lit(1e6)).alias("revenue_musd")).coalesce(
        1).sortWithinPartitions("revenue_musd", "territory")


def report_top_performer(win_rate: DataFrame) -> DataFrame:
    """Rep name with the highest mean win rate (first name in order wins ties)."""
    m = win_rate.groupBy("rep_name").agg(F.avg("win_rate").alias("avg_win_rate"))
    top = m.orderBy(F.col("avg_win_rate").desc(), F.col("rep_name").asc()).limit(1)
    return top.select("rep_name", F.element_at(F.split(F.trim("rep_name"), r"\s+"), -1).alias("last_name"),
                      rnd("avg_win_rate", 6).alias("avg_win_rate"))


def report_cards(win_rate: DataFrame, quota: DataFrame, territory: DataFrame, revenue: DataFrame) -> DataFrame:
    """Total revenue ($M, 1 dp), mean win rate, mean attainment, territories tracked."""
    parts = [revenue.agg(rnd(F.sum("revenue").cast("double") / F.lit(1e6), 1).alias("revenue_musd")),
             win_rate.agg(rnd(F.avg("win_rate"), 6).alias("avg_win_rate")),
             quota.agg(rnd(F.avg("quota_attainment"), 6).alias("avg_attainment")),
             territory.agg(F.count(F.lit(1)).alias("territories"))]
    parts = [p.withColumn("_one", F.lit(1)) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_one")
    return out.drop("_one")


def report_findings(mom: DataFrame, win_rate: DataFrame, quota: DataFrame, accuracy: DataFrame,
                    territory: DataFrame) -> DataFrame:
    """Mean MoM %, mean win rate, mean attainment, mean MAPE, mean territory cycle days."""
    parts = [mom.agg(rnd(F.avg("variance_pct"), 6).alias("avg_mom_growth_pct")),
             win_rate.agg(rnd(F.avg("win_rate"), 6).alias("avg_win_rate")),
             quota.agg(rnd(F.avg("quota_attainment"), 6).alias("avg_attainment")),
             accuracy.agg(rnd(F.avg("mape"), 6).alias("avg_mape")),
             territory.agg(rnd(F.avg("avg_cycle_days"), 6).alias("avg_cycle_days"))]
    parts = [p.withColumn("_one", F.lit(1)) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, "_one")
    return out.drop("_one")
