"""Experiment statistics against published table values and closed forms."""

import math
from decimal import Decimal

import pytest

from quotaloom.functions.stats import chi2_df1, t_two_sided
from quotaloom.operators import experiments as ab


@pytest.mark.parametrize("t,df", [(2.228, 10), (12.706, 1), (2.086, 20), (1.96, 1e6)])
def test_t_table_values(t, df):
    assert abs(t_two_sided(t, df) - 0.05) < 5e-4


def test_many_degrees_of_freedom_approach_the_normal():
    for df in (1e6, 1e8, 1e10, 1e13):
        for t in (0.01, 0.4, 1.0, 2.5, 6.0):
            normal = math.erfc(t / math.sqrt(2))
            # the first correction to the normal limit is t (t² + 1) φ(t) / (2 df)
            near = normal + t * (t * t + 1) * math.exp(-t * t / 2) / math.sqrt(2 * math.pi) / (2 * df)
            assert abs(t_two_sided(t, df) - near) < 1e-10


def test_few_degrees_of_freedom_have_closed_forms():
    for t in (0.1, 0.6, 3.0, 40.0):
        assert abs(t_two_sided(t, 1.0) - (1 - 2 * math.atan(t) / math.pi)) < 1e-9
        assert abs(t_two_sided(t, 2.0) - (1 - t / math.sqrt(2 + t * t))) < 1e-9
    assert abs(t_two_sided(0.49999, 1.3) - t_two_sided(0.50001, 1.3)) < 1e-4


def _ab_rows(spark, won_a, n_a, won_b, n_b):
    rows = [("A", Decimal("1.00"), 1 if i < won_a else 0) for i in range(n_a)]
    rows += [("B", Decimal("2.00"), 1 if i < won_b else 0) for i in range(n_b)]
    return spark.createDataFrame(rows, "campaign_type string, deal_value decimal(18,2), is_won int")


def test_chi_square_yates(spark):
    df = _ab_rows(spark, 30, 100, 45, 100)
    r = ab.ab_chi_square_p(df).first()
    assert r.chi2_statistic == 4.1813 and (r.won_a, r.lost_a, r.won_b, r.lost_b) == (30, 70, 45, 55)
    assert abs(r.p_value - 0.0409) < 1e-3 and r.significant
    assert abs(chi2_df1(3.841459) - 0.05) < 1e-6


def test_cohens_d_constant_groups(spark):
    r = ab.ab_effect_size(_ab_rows(spark, 1, 5, 1, 5)).first()
    assert r.cohens_d == 0.0 and r.effect_magnitude == "Negligible"


def test_welch_against_closed_form(spark):
    import statistics as st
    a = [10.0, 12.0, 9.0, 14.0, 11.0]
    b = [15.0, 13.0, 18.0, 16.0, 17.0, 14.0]
    rows = [("A", Decimal(str(x)), 0) for x in a] + [("B", Decimal(str(x)), 0) for x in b]
    df = spark.createDataFrame(rows, "campaign_type string, deal_value decimal(18,2), is_won int")
    r = ab.ab_welch_ttest_p(df).first()
    va, vb = st.variance(a), st.variance(b)
    t = (st.mean(a) - st.mean(b)) / math.sqrt(va / 5 + vb / 6)
    nu = (va / 5 + vb / 6) ** 2 / ((va / 5) ** 2 / 4 + (vb / 6) ** 2 / 5)
    assert r.t_statistic == round(t, 4) and r.welch_df == round(nu, 4)
    assert r.mean_diff == round(st.mean(b) - st.mean(a), 2)
    assert 0 < r.p_value < 0.01 and r.significant
