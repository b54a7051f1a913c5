"""Dashboard measures (M1–M14) evaluated at any grain.

A grain is a list drawn from the rep attributes (``rep_name``, ``region``, ``territory``),
``month_year`` (revenue / quota / forecast month; opportunities use their close month, as
the date dimension relates to them on close_date), and the opportunity-only attributes
``category`` (products), ``campaign_type`` / ``campaign_name`` (campaigns) and ``stage``.
Facts without a relationship to an opportunity-only attribute are not filtered by it (as
in the dashboard model): they are evaluated at the rest of the grain and attached N:1. Each fact is aggregated
at the grain on its own — per (rep_id, month) first, then through the rep dimension —
and the per-fact results are combined with full outer joins on the grain, which is how
a measure sees "its" rows under a filter context. Empty grain = the whole model.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import attainment_color, dax_band, divide_or, month_key, safe_div, weighted
from ..functions.joins import small

REP_COLS = ("rep_name", "region", "territory")


# Grain columns that only opportunities relate to (through products, campaigns, or their
# own stage); revenue, quota and forecast measures are not filtered by them.
OPP_ONLY = {"category": ("products", "product_id"), "campaign_type": ("campaigns", "campaign_id"),
            "campaign_name": ("campaigns", "campaign_id"), "stage": (None, None)}


def at_grain(fact: DataFrame, reps: DataFrame, grain: Sequence[str], month: Column | None,
             aggs: dict[str, Column], finals: dict[str, Column], dims: dict | None = None) -> DataFrame:
    """Aggregate one fact at ``grain``: partial aggregates per (rep_id[, month][, dimension
    keys]), then through the (size-checked broadcast) dimensions, then the final combination."""
    grain = list(grain)
    dims = dims or {}
    keys = ["rep_id"] + (["month_year"] if "month_year" in grain else [])
    fks = []
    for g in grain:
        if g in OPP_ONLY:
            dim, fk = OPP_ONLY[g]
            name = fk or g
            if name not in fks:
                fks.append(name)
    src = fact if month is None or "month_year" not in grain else fact.withColumn("month_year", month)
    pre = src.groupBy(*keys, *fks).agg(*[v.alias(k) for k, v in aggs.items()])
    rep_cols = [c for c in grain if c in REP_COLS]
    if rep_cols:
        pre = pre.join(small(reps.select("rep_id", *rep_cols)), "rep_id")
    for dim_name, fk in {(OPP_ONLY[g][0], OPP_ONLY[g][1]) for g in grain if g in OPP_ONLY and OPP_ONLY[g][0]}:
        cols = [g for g in grain if OPP_ONLY.get(g, (None,))[0] == dim_name]
        pre = pre.join(small(dims[dim_name].select(fk, *cols)), fk)
    if grain:
        g = pre.groupBy(*grain).agg(*[v.alias(k) for k, v in finals.items()])
    else:
        g = pre.agg(*[v.alias(k) for k, v in finals.items()])
    return g


def _join_all(parts: list[DataFrame], grain: Sequence[str]) -> DataFrame:
    if not grain:  # one-row frames: pair them on a constant key
        parts = [p.withColumn("_one", F.lit(1)) for p in parts]
        return reduce(lambda a, b: a.join(b, "_one"), parts).drop("_one")
    return reduce(lambda a, b: a.join(b, list(grain), "full_outer"), parts)


class Model:
    """The star schema a dashboard sees (facts + rep dimension + date spine)."""

    def __init__(self, opps: DataFrame, revenue: DataFrame, quotas: DataFrame, forecasts: DataFrame,
                 reps: DataFrame, dates: DataFrame | None = None, products: DataFrame | None = None,
                 campaigns: DataFrame | None = None):
        self.opps, self.revenue, self.quotas, self.forecasts, self.reps, self.dates = (
            opps, revenue, quotas, forecasts, reps, dates)
        self.dims = {"products": products, "campaigns": campaigns}

    # per-fact building blocks ---------------------------------
    def revenue_at(self, grain: Sequence[str]) -> DataFrame:
        return at_grain(self.revenue, self.reps, grain, F.col("month_year"),
                        {"r": F.sum("revenue")}, {"_rev": F.sum("r")})

    def quota_at(self, grain: Sequence[str]) -> DataFrame:
        return at_grain(self.quotas, self.reps, grain, F.col("month_year"),
                        {"q": F.sum("quota_amount")}, {"_quota": F.sum("q")})

    def forecast_at(self, grain: Sequence[str]) -> DataFrame:
        return at_grain(self.forecasts, self.reps, grain, F.col("month_year"),
                        {"f": F.sum("forecasted_rev")}, {"_fc": F.sum("f")})

    def opps_at(self, grain: Sequence[str]) -> DataFrame:
        closed = F.col("is_closed") == 1
        return at_grain(
            self.opps, self.reps, grain, month_key("close_date"), dims=self.dims, aggs=
            {"n": F.count(F.lit(1)), "won": F.count(F.when(F.col("is_won") == 1, 1)),
             "closed": F.count(F.when(closed, 1)), "open": F.count(F.when(F.col("is_closed") == 0, 1)),
             "sv": F.sum("deal_value"), "cv": F.count("deal_value"),
             "sdc": F.sum(F.when(closed, F.col("days_in_pipeline"))),
             "cdc": F.count(F.when(closed, F.col("days_in_pipeline"))),
             "wp": F.sum(F.when(F.col("is_closed") == 0, weighted(F.col("deal_value"), F.col("probability"))))},
            finals={"_n": F.sum("n"), "_won": F.sum("won"), "_closed": F.sum("closed"), "_open": F.sum("open"),
             "_sv": F.sum("sv"), "_cv": F.sum("cv"), "_sdc": F.sum("sdc"), "_cdc": F.sum("cdc"), "_wp": F.sum("wp")})


# measure expressions over the per-fact columns ------------------

def total_revenue() -> Column:
    return F.col("_rev").cast("double")


def win_rate() -> Column:
    return divide_or("_won", "_closed", 0.0)


def quota_attainment() -> Column:
    return divide_or("_rev", "_quota", 0.0)


def pipeline_velocity() -> Column:
    avg_deal = safe_div("_sv", "_cv")
    avg_days_closed = safe_div("_sdc", "_cdc")
    return divide_or(F.col("_n") * win_rate() * avg_deal, avg_days_closed, 0.0)


def forecast_accuracy() -> Column:
    actual = F.coalesce(F.col("_rev").cast("double"), F.lit(0.0))
    fc = F.coalesce(F.col("_fc").cast("double"), F.lit(0.0))
    return F.lit(1.0) - divide_or(F.abs(actual - fc), actual, 0.0)


def avg_sales_cycle() -> Column:
    return safe_div("_sdc", "_cdc")


def weighted_pipeline() -> Column:
    return F.col("_wp").cast("double")


def revenue_vs_quota() -> Column:
    return F.coalesce(F.col("_rev").cast("double"), F.lit(0.0)) - F.coalesce(F.col("_quota").cast("double"), F.lit(0.0))


def closed_won_count() -> Column:
    return F.col("_won")


def open_pipeline_count() -> Column:
    return F.col("_open")


def evaluate(model: Model, grain: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Evaluate named measures at ``grain`` in one plan (only the facts they need)."""
    need = {
        "total_revenue": {"rev"}, "win_rate": {"opp"}, "quota_attainment": {"rev", "quota"},
        "pipeline_velocity": {"opp"}, "forecast_accuracy": {"rev", "fc"}, "avg_sales_cycle_days": {"opp"},
        "weighted_pipeline": {"opp"}, "revenue_vs_quota": {"rev", "quota"}, "attainment_band": {"rev", "quota"},
        "closed_won_count": {"opp"}, "open_pipeline_count": {"opp"}, "attainment_color": {"rev", "quota"},
    }
    expr = {
        "total_revenue": total_revenue, "win_rate": win_rate, "quota_attainment": quota_attainment,
        "pipeline_velocity": pipeline_velocity, "forecast_accuracy": forecast_accuracy,
        "avg_sales_cycle_days": avg_sales_cycle, "weighted_pipeline": weighted_pipeline,
        "revenue_vs_quota": revenue_vs_quota, "closed_won_count": closed_won_count,
        "open_pipeline_count": open_pipeline_count,
        "attainment_band": lambda: dax_band(quota_attainment()),
        "attainment_color": lambda: attainment_color(quota_attainment()),
    }
    facts = set().union(*[need[n] for n in names])
    builders = {"rev": model.revenue_at, "quota": model.quota_at, "fc": model.forecast_at, "opp": model.opps_at}
    opp_only = [g for g in grain if g in OPP_ONLY]
    if not opp_only:
        parts = [builders[f](grain) for f in ("rev", "quota", "fc", "opp") if f in facts]
        j = _join_all(parts, grain)
    else:
        # rows: the grain combinations opportunities have; unrelated facts are evaluated at
        # the rest of the grain and attached by an N:1 join on it (DAX: no relationship,
        # no filter)
        rest = [g for g in grain if g not in OPP_ONLY]
        j = model.opps_at(grain)
        others = [builders[f](rest) for f in ("rev", "quota", "fc") if f in facts]
        if others:
            o = _join_all(others, rest)
            j = j.join(o, rest, "left") if rest else j.withColumn("_one", F.lit(1)).join(
                o.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    return j.select(*grain, *[expr[n]().alias(n) for n in names])


def mom_variance_pct(model: Model, by: Sequence[str] = ()) -> DataFrame:
    """M6 at month grain: (month total − previous *calendar* month total) / previous, as a
    fraction, 0 when the previous month is blank or 0.

    No month spine and no window: every (key, month) total also emits a shadow row one
    calendar month later carrying it as "previous"; one aggregation then pairs them.
    Months where both are blank have no row (a visual shows nothing there either).
    """
    by = list(by)
    rev = model.revenue_at([*by, "month_year"]).select(*by, "month_year", F.col("_rev").cast("double").alias("v"))
    nxt = F.date_format(F.add_months(F.to_date(F.concat("month_year", F.lit("-01"))), 1), "yyyy-MM")
    both = rev.select(*by, "month_year", F.col("v").alias("cur"), F.lit(None).cast("double").alias("prev")).unionByName(
        rev.select(*by, nxt.alias("month_year"), F.lit(None).cast("double").alias("cur"), F.col("v").alias("prev")))
    g = both.groupBy(*by, "month_year").agg(F.sum("cur").alias("c"), F.sum("prev").alias("p"))
    cur, prev = F.coalesce(F.col("c"), F.lit(0.0)), F.coalesce(F.col("p"), F.lit(0.0))
    return g.select(*by, "month_year", cur.alias("total_revenue"), prev.alias("prev_month_revenue"),
                    divide_or(cur - prev, prev, 0.0).alias("mom_variance_pct"))


def running_total_revenue(model: Model, by: Sequence[str] = ()) -> DataFrame:
    """M13 by month: revenue up to each calendar month (per ``by`` key that has any): a month without
    revenue carries the total on, months before the first are blank.

    The spine is the calendar's months exploded per key; the window runs over it, one row per
    (key, month), after aggregation.
    """
    by = list(by)
    rev = model.revenue_at([*by, "month_year"]).select(*by, "month_year", "_rev")
    months = model.dates.agg(F.sort_array(F.collect_set(F.substring("date_id", 1, 7))).alias("_months"))
    keys = rev.select(*by).distinct() if by else months.sparkSession.range(1).select()
    spine = keys.withColumn("_one", F.lit(1)).join(months.withColumn("_one", F.lit(1)), "_one")
    spine = spine.select(*by, F.explode("_months").alias("month_year"))
    w = (Window.partitionBy(*by) if by else Window).orderBy("month_year").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return spine.join(rev, [*by, "month_year"], "left").select(
        *by, "month_year", F.sum("_rev").over(w).cast("double").alias("running_total_revenue"))


def mom_variance_pct_daily(model: Model) -> DataFrame:
    """M6 on the date axis: month-to-date revenue up to each calendar day (DATESMTD) vs the
    whole previous calendar month (PREVIOUSMONTH), as a fraction; 0 when the previous
    month is blank or 0. Revenue is first summed per day; the windows and the joins then
    run over calendar days and months (bounded by the date dimension), not fact rows."""
    daily = model.revenue.groupBy(F.col("close_date").alias("d")).agg(F.sum("revenue").alias("r"))
    monthly = daily.groupBy(F.date_format("d", "yyyy-MM").alias("pm")).agg(F.sum("r").alias("prev"))
    spine = model.dates.select(F.to_date("date_id").alias("d"), F.substring("date_id", 1, 7).alias("m"))
    spine = spine.withColumn("pm", F.date_format(F.add_months(F.to_date(F.concat("m", F.lit("-01"))), -1), "yyyy-MM"))
    j = spine.join(daily, "d", "left").join(monthly, "pm", "left")
    w = Window.partitionBy("m").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = j.withColumn("mtd", F.sum("r").over(w))
    cur = F.coalesce(F.col("mtd").cast("double"), F.lit(0.0))
    prev = F.coalesce(F.col("prev").cast("double"), F.lit(0.0))
    return j.select(F.date_format("d", "yyyy-MM-dd").alias("date_id"), F.col("mtd").cast("double").alias("mtd_revenue"),
                    F.col("prev").cast("double").alias("prev_month_revenue"),
                    divide_or(cur - prev, prev, 0.0).alias("mom_variance_pct"))


def running_total_revenue_daily(model: Model) -> DataFrame:
    """M13 on the date axis: revenue with close date up to each calendar day. One ordered
    window over the calendar (a few thousand days), after summing revenue per day."""
    daily = model.revenue.groupBy(F.col("close_date").alias("d")).agg(F.sum("revenue").alias("r"))
    spine = model.dates.select(F.to_date("date_id").alias("d"))
    w = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spine.join(daily, "d", "left").select(
        F.date_format("d", "yyyy-MM-dd").alias("date_id"), F.sum("r").over(w).cast("double").alias("running_total_revenue"))
