"""Tail probabilities for the A/B tests, as vectorised (Arrow) pandas UDFs.

They run on already-aggregated rows (one per test, or one per group key), never on
fact rows. Spark SQL has no t or chi-square CDF, and no statistics library is assumed.

* Student t, two-sided: the density integrated numerically on a finite range, with a
  gamma ratio that does not cancel for many degrees of freedom.
* Chi-square with one degree of freedom: p = erfc(sqrt(x/2)).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .exprs import safe_div

#: Abscissae and weights of the panels' Gauss-Legendre rule; the integrand is smooth on every panel.
_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(24)
_PANELS = 32
#: The integrand is left out where it has fallen by exp(-_FALL).
_FALL = 50.0


def _log_gamma_step(a: float) -> float:
    """ln Γ(a + 1/2) − ln Γ(a); for large a by its asymptotic series, as the difference would cancel."""
    if a < 30:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)


def t_two_sided(t: float | None, df: float | None) -> float | None:
    """P(|T| > |t|) for df degrees of freedom; null without a statistic.

    With x = sqrt(df) tan(u) the density becomes cos(u)^(df − 1) on a finite range, which is integrated over panels
    from |t| to where it no longer counts. Below the median the complement is integrated.
    """
    if t is None or df is None or math.isnan(t) or math.isnan(df) or df <= 0:
        return None
    if math.isinf(t):
        return 0.0
    low, n = math.atan(abs(t) / math.sqrt(df)), df - 1
    scale = 2 * math.exp(_log_gamma_step(df / 2)) / math.sqrt(math.pi)

    def height(u):  # ln of cos(u)^n
        return n * np.log(np.maximum(np.cos(u), 1e-300)) if low > 0.1 else 0.5 * n * np.log1p(-np.minimum(np.sin(u) ** 2, 1 - 1e-16))

    def area(a: float, b: float) -> float:
        cuts = a + (b - a) * (1 - np.linspace(1, 0, _PANELS + 1) ** 3)  # denser towards b, where cos may vanish
        half = np.diff(cuts)[:, None] / 2
        u = (cuts[:-1, None] + half) + half * _NODES
        return float((np.exp(height(u)) * _WEIGHTS * half).sum())

    top = math.pi / 2
    if n > 0:  # cos(u)^n <= exp(-n u²/2), so the tail beyond this has fallen
        top = min(top, math.sqrt(low * low + 2 * _FALL / n))
    if abs(t) < 0.5 or n < 0:  # for df below 1 the density has a pole at the far end: integrate the near part
        return min(1.0, max(0.0, 1.0 - scale * area(0.0, low)))
    return min(1.0, scale * area(low, top))


def chi2_df1(x: float | None) -> float | None:
    if x is None or math.isnan(x) or x < 0:
        return None
    return math.erfc(math.sqrt(x / 2.0))


@pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom."""
    out = [t_two_sided(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b)) for a, b in zip(t, df)]
    return pd.Series(out, dtype="float64")


@pandas_udf(T.DoubleType())
def chi2_pvalue_df1(x: pd.Series) -> pd.Series:
    """Upper-tail p-value of chi-square with one degree of freedom."""
    return pd.Series([chi2_df1(None if pd.isna(v) else float(v)) for v in x], dtype="float64")


def welch_df(va, na, vb, nb):
    """Welch–Satterthwaite degrees of freedom as a Column expression."""
    sa, sb = safe_div(va, na), safe_div(vb, nb)
    return safe_div((sa + sb) * (sa + sb), safe_div(sa * sa, na - F.lit(1.0)) + safe_div(sb * sb, nb - F.lit(1.0)))
