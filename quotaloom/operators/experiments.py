"""A/B experiment statistics (AB1–AB7).

Every test is one aggregation pass of conditional sufficient statistics (count, Σx, Σx²,
won/lost cells) over the experiment rows — optionally per extra key — followed by a
closed form on the aggregated row(s). Only those rows reach Python, for the p-values.
Σx and Σx² are exact sums of whole units (``functions.moments``), so the statistics neither
cancel nor depend on how the data is partitioned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import moments as mo
from ..functions.exprs import ALPHA, effect_magnitude, rnd, safe_div
from ..functions.joins import small
from ..functions.median import exact_median
from ..functions.stats import chi2_pvalue_df1, t_pvalue, welch_df
from ..functions.text import py_format


def ab_dataset(opps: DataFrame, campaigns: DataFrame) -> DataFrame:
    """AB1: closed opportunities with their campaign (8 columns)."""
    o = opps.filter(F.col("is_closed") == 1).select(
        "opportunity_id", "deal_value", "is_won", "is_closed", "days_in_pipeline", "campaign_id")
    c = small(campaigns.select("campaign_id", "campaign_name", "campaign_type"))
    return o.join(c, "campaign_id").select(
        "opportunity_id", "deal_value", "is_won", "is_closed", "days_in_pipeline", "campaign_id",
        "campaign_name", "campaign_type")


def campaign_moments(opps: DataFrame, campaigns: DataFrame, value_col: str = "deal_value",
                     by: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Experiment rows reduced to sufficient statistics before any join: per campaign type (and
    per ``by`` attribute: name → (dimension, its key)) the counts, Σx, Σx² and wins of closed opportunities.

    The fact is grouped by campaign id and dimension keys first, so the joins see a few rows per key,
    however large the fact and however few the campaigns. The result takes the place of the
    experiment rows in every test below.
    """
    by = dict(by or {})
    fks = [fk for _, fk in by.values()]
    closed = opps.filter(F.col("is_closed") == 1)
    pre = closed.groupBy("campaign_id", *fks).agg(*_sufficient(closed, value_col))
    j = pre.join(small(campaigns.select("campaign_id", "campaign_type")), "campaign_id")
    for name, (dim, fk) in by.items():
        j = j.join(small(dim.select(fk, name)), fk)
    return j.groupBy("campaign_type", *by).agg(
        *[F.sum(c).alias(c) for c in ("_rows", "_n", "_won")], F.sum("_s1").cast("decimal(38,0)").alias("_s1"),
        F.try_sum("_s2").alias("_s2"), F.max("_digits").alias("_digits"))


def _sufficient(df: DataFrame, value_col: str) -> list[Column]:
    """Rows, and n, Σx, Σx² of ``value_col`` in whole units, of which ``_digits`` are behind the point; won rows."""
    n, s1, s2 = mo.sums(df, value_col)
    won = F.sum("is_won") if "is_won" in df.columns else F.lit(None).cast("bigint")
    digits = F.max(F.lit(mo.unit_digits(df.schema[value_col].dataType)))
    return [F.count(F.lit(1)).alias("_rows"), n.alias("_n"), s1.alias("_s1"), s2.alias("_s2"), won.alias("_won"), digits.alias("_digits")]


def _reduced(df: DataFrame, group_col: str, value_col: str, by: Sequence[str]) -> DataFrame:
    """``df`` if it is already reduced, else its statistics per group."""
    if "_s2" in df.columns:
        return df
    return df.groupBy(group_col, *by).agg(*_sufficient(df, value_col))


def moments(df: DataFrame, group_col: str, value_col: str, group_a: str = "A", group_b: str = "B",
            by: Sequence[str] = ()) -> DataFrame:
    """n, Σx, Σx² in whole units of ``value_col`` (nulls dropped) for groups a and b, per ``by``."""
    r, aggs = _reduced(df, group_col, value_col, by), [F.max("_digits").alias("_digits")]
    for tag, lab in (("a", group_a), ("b", group_b)):
        inn = F.col(group_col) == F.lit(lab)
        aggs += [F.coalesce(F.sum(F.when(inn, F.col("_n"))), F.lit(0)).cast("bigint").alias(f"n_{tag}"),
                 F.sum(F.when(inn, F.col("_s1"))).cast("decimal(38,0)").alias(f"s1_{tag}"),
                 F.try_sum(F.when(inn, F.col("_s2"))).alias(f"s2_{tag}")]
    return r.groupBy(*by).agg(*aggs) if by else r.agg(*aggs)


def _mean_var(tag: str) -> tuple[Column, Column]:
    n, s1, s2 = (F.col(f"{c}_{tag}") for c in ("n", "s1", "s2"))
    unit = F.pow(F.lit(10.0), F.col("_digits"))
    return mo.mean(n, s1, 0) / unit, mo.variance(n, s1, s2, 0) / (unit * unit)


def welch_stats(df: DataFrame, group_col: str, value_col: str, group_a: str = "A", group_b: str = "B",
                by: Sequence[str] = ()) -> DataFrame:
    """AB2 statistics: n, means, difference (b − a), difference %, Welch t (a − b), ν. Flat groups have no t."""
    m = moments(df, group_col, value_col, group_a, group_b, by)
    ma, va = _mean_var("a")
    mb, vb = _mean_var("b")
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    unit = F.pow(F.lit(10.0), F.col("_digits"))
    more = mo.mean_difference(F.col("n_a"), F.col("s1_a"), F.col("n_b"), F.col("s1_b"), 0) / unit
    t = safe_div(-more, F.sqrt(safe_div(va, na) + safe_div(vb, nb)))
    pooled = F.sqrt((va + vb) / F.lit(2.0))
    m = m.select(*by, "n_a", "n_b", ma.alias("_ma"), mb.alias("_mb"), more.alias("_more"), t.alias("_t"),
                 welch_df(va, na, vb, nb).alias("_df"),
                 F.when(pooled > 0, safe_div(more, pooled)).otherwise(F.lit(0.0)).alias("_d"))
    return m.select(
        *by, F.lit("Independent t-test (Welch's)").alias("test"), F.lit(value_col).alias("metric"),
        F.lit(group_a).alias("group_a"), F.lit(group_b).alias("group_b"), "n_a", "n_b",
        rnd("_ma", 2).alias("mean_a"), rnd("_mb", 2).alias("mean_b"),
        rnd("_more", 2).alias("mean_diff"),
        rnd(safe_div("_more", "_ma") * F.lit(100.0), 2).alias("mean_diff_pct"),
        rnd("_t", 4).alias("t_statistic"), rnd("_df", 4).alias("welch_df"),
        F.col("_t").alias("_t_raw"), F.col("_df").alias("_df_raw"), F.col("_ma").alias("_ma_raw"),
        F.col("_more").alias("_more_raw"), F.col("_d").alias("_d_raw"))


def _public(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def ab_welch_ttest(df: DataFrame, group_col: str = "campaign_type", value_col: str = "deal_value",
                   group_a: str = "A", group_b: str = "B") -> DataFrame:
    """AB2 statistics columns (exactly reproducible by SQL)."""
    return _public(welch_stats(df, group_col, value_col, group_a, group_b))


def ab_welch_ttest_p(df: DataFrame, group_col: str = "campaign_type", value_col: str = "deal_value",
                     group_a: str = "A", group_b: str = "B") -> DataFrame:
    """AB2 with p-value, significance at α and the conclusion text."""
    s = welch_stats(df, group_col, value_col, group_a, group_b)
    s = s.withColumn("_p", t_pvalue(F.col("_t_raw"), F.col("_df_raw")))
    sig = F.col("_p") < ALPHA
    pct = F.abs(safe_div("_more_raw", "_ma_raw") * F.lit(100.0))
    # The wording of both conclusions.
    yes = py_format(
        f"Statistically significant difference in {value_col} (p={{0:.4f}} < α={ALPHA}). "
        f"Group {group_b} mean is {{1:.1f}}% {{2}} than Group {group_a}.",
        F.col("_p"), pct, F.when(F.col("_more_raw") > 0, "higher").otherwise("lower"))
    no = py_format(
        f"No statistically significant difference in {value_col} (p={{0:.4f}} ≥ α={ALPHA}). "
        "Cannot conclude the campaigns perform differently.", F.col("_p"))
    return _public(s.select("*", rnd("_p", 6).alias("p_value"), F.lit(ALPHA).alias("alpha"),
                            sig.alias("significant"), F.when(sig, yes).otherwise(no).alias("conclusion")))


def chi_square_stats(df: DataFrame, group_col: str = "campaign_type", group_a: str = "A", group_b: str = "B",
                     by: Sequence[str] = ()) -> DataFrame:
    """AB3 statistics: 2×2 won/lost cells, win rates, Yates-corrected χ² (dof 1)."""
    r, aggs = _reduced(df, group_col, "is_won", by), []
    for tag, lab in (("a", group_a), ("b", group_b)):
        inn = F.col(group_col) == F.lit(lab)
        aggs += [F.coalesce(F.sum(F.when(inn, F.col("_rows"))), F.lit(0)).cast("bigint").alias(f"n_{tag}"),
                 F.sum(F.when(inn, F.col("_won"))).alias(f"won_{tag}")]
    c = r.groupBy(*by).agg(*aggs) if by else r.agg(*aggs)
    c = c.select(*by, "n_a", "n_b", F.coalesce(F.col("won_a"), F.lit(0)).cast("bigint").alias("won_a"),
                 F.coalesce(F.col("won_b"), F.lit(0)).cast("bigint").alias("won_b"))
    c = c.withColumn("lost_a", F.col("n_a") - F.col("won_a")).withColumn("lost_b", F.col("n_b") - F.col("won_b"))
    a, b, cc, d = (F.col(x).cast("double") for x in ("won_a", "lost_a", "won_b", "lost_b"))
    n = a + b + cc + d
    num = F.greatest(F.abs(a * d - b * cc) - n / F.lit(2.0), F.lit(0.0))
    den = (a + b) * (cc + d) * (a + cc) * (b + d)
    chi2 = F.when(den > 0, n * num * num / den)
    return c.select(
        *by, F.lit("Chi-square test").alias("test"), F.lit("win_rate").alias("metric"),
        F.lit(group_a).alias("group_a"), F.lit(group_b).alias("group_b"), "n_a", "n_b",
        rnd(safe_div("won_a", "n_a"), 4).alias("win_rate_a"), rnd(safe_div("won_b", "n_b"), 4).alias("win_rate_b"),
        "won_a", "lost_a", "won_b", "lost_b", rnd(chi2, 4).alias("chi2_statistic"),
        F.lit(1).alias("degrees_of_freedom"), chi2.alias("_chi2"))


def ab_chi_square(df: DataFrame, group_col: str = "campaign_type", group_a: str = "A", group_b: str = "B") -> DataFrame:
    return _public(chi_square_stats(df, group_col, group_a, group_b))


def ab_chi_square_p(df: DataFrame, group_col: str = "campaign_type", group_a: str = "A",
                    group_b: str = "B") -> DataFrame:
    """AB3 with p-value (erfc form for one degree of freedom), significance, conclusion."""
    s = chi_square_stats(df, group_col, group_a, group_b).withColumn("_p", chi2_pvalue_df1(F.col("_chi2")))
    sig = F.col("_p") < ALPHA
    wa, wb = F.col("win_rate_a"), F.col("win_rate_b")
    # The wording of both conclusions.
    yes = py_format(
        f"Statistically significant difference in win rate (p={{0:.4f}} < α={ALPHA}). "
        f"Group {group_b} win rate ({{1:.1%}}) vs Group {group_a} ({{2:.1%}}) — difference of {{3:.1%}}.",
        F.col("_p"), wb, wa, F.abs(wb - wa))
    no = py_format(
        f"No statistically significant difference in win rate (p={{0:.4f}} ≥ α={ALPHA}). "
        f"Groups {group_a} ({{1:.1%}}) and {group_b} ({{2:.1%}}) are comparable.", F.col("_p"), wa, wb)
    return _public(s.select("*", rnd("_p", 6).alias("p_value"), F.lit(ALPHA).alias("alpha"),
                            sig.alias("significant"), F.when(sig, yes).otherwise(no).alias("conclusion")))


def ab_effect_size(df: DataFrame, group_col: str = "campaign_type", value_col: str = "deal_value",
                   group_a: str = "A", group_b: str = "B") -> DataFrame:
    """AB4: Cohen's d = (mean b − mean a) / sqrt((s²a + s²b) / 2); 0 when that is 0."""
    s = welch_stats(df, group_col, value_col, group_a, group_b)
    return s.select(rnd("_d_raw", 4).alias("cohens_d"), effect_magnitude("_d_raw").alias("effect_magnitude"))


def campaign_summary(df: DataFrame) -> DataFrame:
    """AB5: per campaign name and type: counts, win rate, mean/median/std deal value,
    won revenue, mean days — all rounded to 2 dp; rows with a null key dropped."""
    keys = ["campaign_name", "campaign_type"]
    d = df.filter(F.col("campaign_name").isNotNull() & F.col("campaign_type").isNotNull())
    won = F.col("is_won") == 1
    n_value, s1, s2 = mo.sums(d, "deal_value")
    digits = mo.unit_digits(d.schema["deal_value"].dataType)
    g = d.groupBy(*keys).agg(
        F.count("opportunity_id").alias("total_opps"), F.sum("is_won").cast("bigint").alias("won_opps"),
        F.sum("is_won").alias("_sw"), F.count("is_won").alias("_cw"),
        F.sum("deal_value").alias("_sv"), n_value.alias("_n"), s1.alias("_s1"), s2.alias("_s2"),
        F.sum(F.when(won, F.col("deal_value")).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("_rev"),
        F.sum("days_in_pipeline").alias("_sd"), F.count("days_in_pipeline").alias("_cd"))
    var = mo.variance(F.col("_n"), F.col("_s1"), F.col("_s2"), digits)
    med = exact_median(d, keys, "deal_value", "_median")
    g = g.join(med, keys, "left")
    return g.select(*keys, "total_opps", "won_opps", rnd(safe_div("_sw", "_cw"), 2).alias("win_rate"),
                    rnd(safe_div("_sv", "_n"), 2).alias("avg_deal_value"), rnd("_median", 2).alias("median_deal_value"),
                    rnd(F.sqrt(var), 2).alias("std_deal_value"), rnd("_rev", 2).alias("total_revenue"),
                    rnd(safe_div("_sd", "_cd"), 2).alias("avg_cycle_days"))


def ab_report(df: DataFrame, group_col: str = "campaign_type", value_col: str = "deal_value",
              group_a: str = "A", group_b: str = "B") -> DataFrame:
    """AB6: t-test statistics and Cohen's d in one row, plus the number of campaign types."""
    s = welch_stats(df, group_col, value_col, group_a, group_b)
    types = df.agg(F.countDistinct(group_col).alias("n_campaign_types")).withColumn("_one", F.lit(1))
    s = s.withColumn("_one", F.lit(1)).join(types, "_one")
    return _public(s.select("*", rnd("_d_raw", 4).alias("cohens_d"),
                            effect_magnitude("_d_raw").alias("effect_magnitude")))


def ab_tests_grouped(df: DataFrame, by: Sequence[str], group_col: str = "campaign_type",
                     value_col: str = "deal_value", group_a: str = "A", group_b: str = "B") -> DataFrame:
    """AB7: t-test, Cohen's d and χ² per value of ``by`` in one job, each with p-value, significance and
    magnitude. A key with flat or missing groups has null statistics; it does not stop the others."""
    by = list(by)
    t = welch_stats(df, group_col, value_col, group_a, group_b, by).withColumn("_p", t_pvalue(F.col("_t_raw"), F.col("_df_raw")))
    t = t.select(*by, "n_a", "n_b", "mean_a", "mean_b", "t_statistic", "welch_df", rnd("_p", 6).alias("p_value"),
                 (F.col("_p") < ALPHA).alias("significant"), rnd("_d_raw", 4).alias("cohens_d"),
                 effect_magnitude("_d_raw").alias("effect_magnitude"))
    c = chi_square_stats(df, group_col, group_a, group_b, by).withColumn("_p", chi2_pvalue_df1(F.col("_chi2")))
    c = c.select(*by, F.col("n_a").alias("cases_a"), F.col("n_b").alias("cases_b"), "win_rate_a", "win_rate_b",
                 "chi2_statistic", rnd("_p", 6).alias("chi2_p_value"), (F.col("_p") < ALPHA).alias("chi2_significant"))
    return t.join(c, by, "full_outer")
