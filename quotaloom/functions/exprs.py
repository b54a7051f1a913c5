"""Column expressions shared by every operator.

All of them are built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; none needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's behaviour.
# Valid opportunity stages, in funnel order.
VALID_STAGES = ["Prospecting", "Qualification", "Proposal", "Negotiation", "Closed Won", "Closed Lost"]
# Significance level of the A/B tests.
ALPHA = 0.05
# KPI attainment band (right-closed bins at 0.5, 0.8, 1.0, 1.2).
KPI_BAND_LABELS = ["<50%", "50-80%", "80-100%", "100-120%", ">120%"]
# Dashboard attainment band (left-closed thresholds 1.2, 1.0, 0.8, 0.5).
DAX_BAND_LABELS = [
    "Exceeds (>120%)",
    "On Track (100-120%)",
    "Near Target (80-100%)",
    "At Risk (50-80%)",
    "Critical (<50%)",
]
# Dashboard colour rule for attainment (>=1.2, >=1.0, >=0.8, else).
ATTAINMENT_COLORS = ["#10B981", "#2563EB", "#F59E0B", "#EF4444"]
# Cohen's d magnitude thresholds (<0.2, <0.5, <0.8, else).
EFFECT_LABELS = ["Negligible", "Small", "Medium", "Large"]

# Text tokens that a CSV reader treats as missing by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the scaled double.

    Spark's ``round`` and DuckDB's ``round`` disagree on binary ties; this form gives
    the same double in both engines. From 2^53 on the scaled double has no fraction, so the
    value is its own rounding (and ``floor``, a BIGINT in Spark, would saturate).
    """
    x = col(c).cast("double")
    p = float(10 ** digits)
    scaled = F.abs(x) * F.lit(p)
    return F.when(scaled < F.lit(2.0 ** 53), F.signum(x) * F.floor(scaled + F.lit(0.5)) / F.lit(p)).otherwise(x)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / den as double, null when den is 0 or null (SQL ``NULLIF`` semantics)."""
    d = col(den).cast("double")
    return col(num).cast("double") / F.when(d != 0, d)


def weighted(value: Column, probability: Column) -> Column:
    """value · probability / 100 in exact DECIMAL, so that sums of it do not depend on order."""
    return value.cast("decimal(18,2)") * probability.cast("decimal(13,10)") * F.lit(0.01).cast("decimal(3,2)")


def divide_or(num: Column | str, den: Column | str, alt: float = 0.0) -> Column:
    """DIVIDE(num, den, alt): alt when den is zero or blank."""
    return F.coalesce(safe_div(num, den), F.lit(float(alt)))


def mean(c: Column | str) -> Column:
    """Average as sum/count in double: exact sums, one division (no DECIMAL avg scale)."""
    x = col(c)
    return F.sum(x).cast("double") / F.count(x)


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Two-sided clip that keeps nulls (``greatest``/``least`` alone would skip them)."""
    x = col(c)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNotNull(), out)


def strip(c: Column | str) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def title_case(c: Column | str) -> Column:
    """Capitalise the first letter after any non-letter, lower-case the rest."""
    parts = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(
        F.transform(parts, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30))),
        "",
    )


def month_key(d: Column | str) -> Column:
    """'yyyy-MM' text key; lexical order is time order."""
    return F.date_format(col(d), "yyyy-MM")


def month_start(m: Column | str) -> Column:
    """First day of a 'yyyy-MM' month key; null for any other text."""
    return F.try_to_date(F.concat(col(m), F.lit("-01")), "yyyy-MM-dd")


def null_tokens(c: Column | str) -> Column:
    """Map empty strings and the missing-value tokens to null (landing rule)."""
    if isinstance(c, str):
        return F.expr(_null_tokens_sql(_q(c)))
    return F.when(~c.isin(NA_TOKENS), c)


def _q(name: str) -> str:
    """Quoted column reference for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _lit_sql(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Texts that count as numbers.
_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"
_TOKENS_SQL = ", ".join(_lit_sql(t) for t in NA_TOKENS)


def _null_tokens_sql(x: str) -> str:
    return f"CASE WHEN {x} IN ({_TOKENS_SQL}) THEN NULL ELSE {x} END"


def _strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\\\s+|\\\\s+$', '')"


def title_case_text(name: str) -> Column:
    """title_case(strip(to_text(name))) for a string column, as one SQL expression."""
    x = _strip_sql(_null_tokens_sql(_q(name)))
    return F.expr(f"array_join(transform(regexp_extract_all(lower({x}), '(\\\\p{{L}}+|[^\\\\p{{L}}]+)', 1), "
                  f"t -> concat(upper(substring(t, 1, 1)), substring(t, 2))), '')")


def _is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.StringType, T.VarcharType, T.CharType))


def to_date_lenient(df: DataFrame, name: str) -> Column:
    """Coerce to DATE; bad text becomes null (never an error)."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, T.DateType):
        return c
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    x = _null_tokens_sql(_strip_sql(f"CAST({_q(name)} AS STRING)"))
    return F.expr(f"coalesce(try_to_date({x}, 'yyyy-MM-dd'), try_to_date({x}, 'yyyy/MM/dd'), "
                  f"try_to_date({x}, 'MM/dd/yyyy'), to_date(try_to_timestamp({x})))")


def to_number(df: DataFrame, name: str, dtype: str = "double") -> Column:
    """Coerce to a number; bad text and NaN become null."""
    dt = df.schema[name].dataType
    x = _q(name)
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        x = _null_tokens_sql(_strip_sql(x))
        x = f"CASE WHEN {x} RLIKE '{_NUMBER}' THEN {x} END"  # a cast alone would take '12d' for 12
    d = f"try_cast({x} AS DOUBLE)"
    d = f"CASE WHEN NOT isnan({d}) THEN {d} END"
    return F.expr(d if dtype == "double" else f"try_cast({d} AS {dtype.upper()})")


def to_text(df: DataFrame, name: str) -> Column:
    """Text column with missing tokens mapped to null (landing rule for keys)."""
    if _is_string(df, name):
        return F.expr(_null_tokens_sql(_q(name)))
    return F.col(name).cast("string")


def kpi_band(att: Column | str) -> Column:
    """Right-closed attainment bins: (-inf,.5] (.5,.8] (.8,1] (1,1.2] (1.2,inf)."""
    a = col(att)
    lab = KPI_BAND_LABELS
    return (
        F.when(a <= 0.5, lab[0])
        .when(a <= 0.8, lab[1])
        .when(a <= 1.0, lab[2])
        .when(a <= 1.2, lab[3])
        .when(a.isNotNull(), lab[4])
    )


def dax_band(att: Column | str) -> Column:
    """Left-closed dashboard band; a blank attainment falls to the last label."""
    a = col(att)
    lab = DAX_BAND_LABELS
    return (
        F.when(a >= 1.2, lab[0])
        .when(a >= 1.0, lab[1])
        .when(a >= 0.8, lab[2])
        .when(a >= 0.5, lab[3])
        .otherwise(lab[4])
    )


def attainment_color(att: Column | str) -> Column:
    a = col(att)
    c = ATTAINMENT_COLORS
    return F.when(a >= 1.2, c[0]).when(a >= 1.0, c[1]).when(a >= 0.8, c[2]).otherwise(c[3])


def effect_magnitude(d: Column | str) -> Column:
    a = F.abs(col(d))
    lab = EFFECT_LABELS
    return F.when(a < 0.2, lab[0]).when(a < 0.5, lab[1]).when(a < 0.8, lab[2]).otherwise(lab[3])


def iso_date_text(df: DataFrame) -> DataFrame:
    """Render DATE columns as ISO text (used for result sets handed to other tools)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            out.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
