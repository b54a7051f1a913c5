"""Variances and the tests built on them: flat groups, large amounts with tiny spread, any number of partial groups."""

import random
import statistics
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from quotaloom.functions import moments as mo
from quotaloom.operators import experiments as ab

ROW = "campaign_type string, deal_value decimal(18,2), is_won int"


def rows(spark, **arms):
    return spark.createDataFrame([(k, Decimal(v), i % 2) for k, vs in arms.items() for i, v in enumerate(vs)], ROW)


def test_flat_groups_have_no_t(spark):
    df = rows(spark, A=["33.33"] * 3, B=["44.44"] * 7)
    t = ab.ab_welch_ttest_p(df).first()
    assert (t.mean_a, t.mean_b, t.mean_diff) == (33.33, 44.44, 11.11)
    assert t.t_statistic is None and t.p_value is None and t.significant is None
    assert ab.ab_effect_size(df).first().cohens_d == 0.0


def test_large_amounts_with_a_tiny_spread(spark):
    a = [f"1000000000.0{i % 3}" for i in range(1000)]
    b = [f"1000000000.0{1 + i % 3}" for i in range(1000)]
    t = ab.ab_welch_ttest(rows(spark, A=a, B=b).repartition(7)).first()
    xs, ys = ([Fraction(x) for x in v] for v in (a, b))
    want = float(statistics.mean(xs) - statistics.mean(ys)) / float(statistics.variance(xs) / 1000 + statistics.variance(ys) / 1000) ** 0.5
    assert t.t_statistic == pytest.approx(want, abs=1e-4) and abs(t.t_statistic) > 25
    d = rows(spark, A=a).selectExpr("*", "'c' AS campaign_name", "1 AS opportunity_id", "1 AS days_in_pipeline")
    assert ab.campaign_summary(d).first().std_deal_value == 0.01


@pytest.mark.parametrize("scale", [1, 10**4, 10**9])
def test_variance_equals_exact_fractions(spark, scale):
    draw = random.Random(scale)
    vs = [Decimal(draw.randint(-999, 999) + 7 * scale * 10**5) / 100 for _ in range(400)]
    df = spark.createDataFrame([(v, i % 9) for i, v in enumerate(vs)], "v decimal(18,2), g int").repartition(6)
    n, s1, s2 = mo.sums(df, "v")
    part = df.groupBy("g").agg(n.alias("n"), s1.alias("s1"), s2.alias("s2"))  # partial groups merge exactly
    both = part.agg(F.sum("n").alias("n"), F.sum("s1").cast("decimal(38,0)").alias("s1"), F.try_sum("s2").alias("s2"))
    got = both.select(mo.variance(F.col("n"), F.col("s1"), F.col("s2"), 2).alias("v"), mo.mean(F.col("n"), F.col("s1"), 2).alias("m")).first()
    assert got.v == pytest.approx(float(statistics.variance(map(Fraction, vs))), rel=1e-13)
    assert got.m == pytest.approx(float(statistics.mean(map(Fraction, vs))), rel=1e-15)


def test_one_value_none_and_too_many_digits(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", 1), ("c", 2)], "g string, v long")
    n, s1, s2 = mo.sums(df, "v")
    got = {r.g: r.v for r in df.groupBy("g").agg(mo.variance(n, s1, s2, 0).alias("v")).collect()}
    assert got == {"a": None, "b": None, "c": 0.5}
    big = spark.createDataFrame([(Decimal("9" * 18),)] * 200, "v decimal(18,0)")
    n, s1, s2 = mo.sums(big, "v")
    assert big.agg(mo.variance(n, s1, s2, 0).alias("v")).first().v is None  # the squares need 39 digits
    with pytest.raises(TypeError):
        mo.sums(spark.createDataFrame([(1.5,)], "v double"), "v")


def test_flat_keys_do_not_stop_the_others(spark):
    df = rows(spark, A=["1.00", "2.00", "3.00"], B=["2.00", "4.00", "9.00"]).withColumn("k", F.lit("spread"))
    flat = rows(spark, A=["33.33"] * 3, B=["44.44"] * 7).withColumn("k", F.lit("flat"))
    got = {r.k: r for r in ab.ab_tests_grouped(df.union(flat), ["k"]).collect()}
    assert got["flat"].t_statistic is None and got["flat"].p_value is None
    assert got["spread"].t_statistic == pytest.approx(-3 / (14 / 3) ** 0.5, abs=1e-4)
