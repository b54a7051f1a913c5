"""Mean and variance that do not cancel, from exact mergeable sums.

An amount DECIMAL(p, s) with p <= 18 is the whole number c of its smallest unit. Σc and Σc² are added exactly
(DECIMAL(38,0)), in any order and over any number of partial groups. With m the whole number nearest to the mean and
r = Σc − n·m, the squares about m are Σ(c − m)² = Σc² − m·(Σc + r), still exact, and the centred sum of squares is that
less r²/n. As |r| <= n/2, this last subtraction loses at most one bit; nothing is squared after a division, and n·Σc²,
which outgrows 38 digits first, never appears. Equal amounts have variance 0 exactly.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = "decimal(38,0)"


def unit_digits(dt: T.DataType) -> int | None:
    """Digits after the point of an exact amount type; None for types whose sums are not exact."""
    if isinstance(dt, T.DecimalType):
        return dt.scale if dt.precision <= 18 else None
    return 0 if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else None


def whole(df: DataFrame, value: str) -> Column:
    """``value`` as a whole number of its smallest unit, DECIMAL(18,0); null where a long has more digits."""
    digits = unit_digits(df.schema[value].dataType)
    if digits is None:
        raise TypeError(f"{value} is {df.schema[value].dataType.simpleString()}: exact sums need DECIMAL of at most 18 digits, or whole numbers")
    c = F.col(value).try_cast("decimal(18,0)") if not digits else F.col(value) * F.lit(Decimal(10**digits))
    return c.cast("decimal(18,0)")


def sums(df: DataFrame, value: str) -> tuple[Column, Column, Column]:
    """Aggregates (n, Σc, Σc²) of ``value``, nulls left out; Σc² is null beyond 38 digits."""
    c = whole(df, value)
    return F.count(value), F.sum(c).cast(_WHOLE), F.try_sum((c * c).cast(_WHOLE))


def nearest_whole(n: Column, s1: Column) -> tuple[Column, Column]:
    """(m, r): the whole number nearest to the mean, and Σc − n·m; null for n = 0."""
    count = F.when(n > 0, n).cast("decimal(20,0)")
    m = F.round(s1 / count, 0).cast(_WHOLE)
    return m, (s1 - (m * count).cast(_WHOLE)).cast(_WHOLE)


def variance(n: Column, s1: Column, s2: Column, digits: int) -> Column:
    """Sample variance (double) of the amounts; null below two of them."""
    m, r = nearest_whole(n, s1)
    about_m = (s2 - F.try_multiply(m, (s1 + r).cast(_WHOLE)).cast(_WHOLE)).cast("double")
    size, rest = n.cast("double"), r.cast("double")
    centred = about_m - rest * rest / F.when(n > 0, size)
    return F.when(centred < 0, F.lit(0.0)).otherwise(centred) / F.when(n > 1, size - F.lit(1.0)) / F.lit(float(10 ** (2 * digits)))


def mean(n: Column, s1: Column, digits: int) -> Column:
    return s1.cast("double") / F.lit(float(10**digits)) / F.when(n > 0, n.cast("double"))


def mean_difference(n_a: Column, a: Column, n_b: Column, b: Column, digits: int) -> Column:
    """Mean of b less mean of a from their sums Σc: the whole parts are subtracted exactly."""
    (ma, ra), (mb, rb) = nearest_whole(n_a, a), nearest_whole(n_b, b)
    rest = rb.cast("double") / F.when(n_b > 0, n_b.cast("double")) - ra.cast("double") / F.when(n_a > 0, n_a.cast("double"))
    return ((mb - ma).cast("double") + rest) / F.lit(float(10**digits))
