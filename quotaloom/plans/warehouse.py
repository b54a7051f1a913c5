"""Star-schema assembly: raw extracts → cleaned dimensions and facts (lazy plans).

``Warehouse`` holds one lazily built DataFrame per table. Two builders:
``from_testdata`` (the driver's parquet tables through the adapter) and
``from_extracts`` (the seven CSV extracts of the reference's layout).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import month_start, rnd
from ..operators import clean, derive
from ..sources import landing, testdata, versions

# Fixed values of the adapter (driver tables): the quota grid's months.
ADAPTER_FIRST_MONTH = "1995-01"
ADAPTER_LAST_MONTH = "2001-12"


def months_between(first: str, last: str) -> list[str]:
    """The 'yyyy-MM' keys from ``first`` to ``last``."""
    (y0, m0), (y1, m1) = (map(int, m.split("-")) for m in (first, last))
    return [f"{k // 12}-{k % 12 + 1:02d}" for k in range(12 * y0 + m0 - 1, 12 * y1 + m1)]


@dataclass
class Warehouse:
    spark: SparkSession
    source: str
    kind: str = "testdata"  # or "extracts" (CSV landing) or "tables" (a written warehouse)
    first_day: str | None = None  # calendar of the extracts; from the data where not given
    last_day: str | None = None
    fmt: str = "parquet"  # of a written warehouse without commits; a committed version knows its own
    _raw: dict = field(default_factory=dict)

    # ── raw extracts ─────────────────────────────────────────
    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self._build_raw(name)
        return self._raw[name]

    def _build_raw(self, name: str) -> DataFrame:
        if self.kind == "tables":
            raise KeyError(f"a stored warehouse has no raw extract {name!r}")
        if self.kind == "extracts":
            return landing.read_extract(self.spark, self.source, name)
        sp, d = self.spark, self.source
        if name == "reps":
            return testdata.raw_reps(sp, d)
        if name == "products":
            return testdata.raw_products(sp, d)
        if name == "campaigns":
            return testdata.raw_campaigns(sp, d)
        if name == "opportunities":
            return testdata.as_opportunities(self.lines)
        if name == "revenue":
            return derive.derive_bookings(self.opportunities)
        if name == "quotas":
            amount = F.lit(80000.0) + F.lit(1000.0) * (F.col("rep_id") % 40)
            return derive.quota_spine(self.reps, ADAPTER_FIRST_MONTH, ADAPTER_LAST_MONTH, amount)
        if name == "forecasts":
            return adapter_forecasts(self.revenue)
        raise KeyError(name)

    @cached_property
    def lines(self) -> DataFrame:
        """What the opportunities of the driver tables are made of; a job that reads it often sets it to a stored copy."""
        return testdata.opportunity_lines(self.spark, self.source)

    # ── processed tables ─────────────────────────────────────
    @cached_property
    def reps(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("dim_reps")
        return clean.clean_reps(self.raw("reps"))

    @cached_property
    def products(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("dim_products")
        return clean.clean_products(self.raw("products"))

    @cached_property
    def campaigns(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("dim_campaigns")
        return clean.clean_campaigns(self.raw("campaigns"))

    @cached_property
    def opportunities(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("fact_opportunities")
        if self.kind == "testdata":
            return clean.clean_opportunities(testdata.first_opportunities(testdata.first_lines(self.lines)), unique=True)
        return clean.clean_opportunities(self.raw("opportunities"))

    @cached_property
    def revenue(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("fact_revenue")
        return clean.clean_revenue(self.raw("revenue"), unique=self.kind == "testdata")

    @cached_property
    def quotas(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("fact_quotas")
        return clean.clean_quotas(self.raw("quotas"), unique=self.kind == "testdata")

    @cached_property
    def forecasts(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("fact_forecasts")
        return clean.clean_forecasts(self.raw("forecasts"), unique=self.kind == "testdata")

    @cached_property
    def dates(self) -> DataFrame:
        if self.kind == "tables":
            return self._stored("dim_date")
        if self.kind == "extracts":
            return clean.dim_date_between(self._span())
        return clean.dim_date_between(testdata.date_bounds(self.spark, self.source))

    def _span(self) -> DataFrame:
        """One row (start, end): the days given, else whole years around the closing dates and quota months."""
        days = self.opportunities.select(F.col("close_date").alias("d")).unionByName(
            self.opportunities.select(F.col("created_date").alias("d"))).unionByName(
            self.revenue.select(F.col("close_date").alias("d"))).unionByName(
            self.quotas.select(month_start("month_year").alias("d")))
        first, last = F.date_trunc("year", F.min("d")).cast("date"), F.make_date(F.year(F.max("d")), F.lit(12), F.lit(31))
        given = lambda day, found: F.lit(day).cast("date") if day else found
        return days.agg(given(self.first_day, first).alias("start"), given(self.last_day, last).alias("end")).filter(
            "start IS NOT NULL AND end IS NOT NULL")

    @cached_property
    def version(self) -> versions.Version | None:
        """The committed version that all tables of this object are read from; later commits do not change it."""
        return versions.current(self.spark, self.source)

    def _stored(self, table: str) -> DataFrame:
        if self.version:
            return versions.read(self.spark, self.source, self.version, table)
        return landing.read_processed(self.spark, self.source, table, self.fmt)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_reps": self.reps, "dim_products": self.products, "dim_campaigns": self.campaigns,
            "dim_date": self.dates, "fact_opportunities": self.opportunities, "fact_revenue": self.revenue,
            "fact_quotas": self.quotas, "fact_forecasts": self.forecasts,
        }


def adapter_forecasts(revenue: DataFrame) -> DataFrame:
    """Forecast extract of the adapter: monthly rep revenue × a factor in [0.80, 1.25]."""
    b = derive.forecast_baseline(revenue)
    month = F.substring("month_year", 6, 2).cast("int")
    factor = F.lit(0.80) + ((F.lit(7) * F.col("rep_id") + month) % 46).cast("double") / F.lit(100.0)
    return b.select(
        F.concat_ws("-", F.col("rep_id").cast("string"), F.col("month_year")).alias("forecast_id"),
        "rep_id", "month_year",
        rnd(F.col("revenue").cast("double") * factor, 2).alias("forecasted_rev"),
        "forecast_date",
    )


def from_testdata(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir, "testdata")


def from_extracts(spark: SparkSession, raw_dir: str, first_day: str | None = None,
                  last_day: str | None = None) -> Warehouse:
    """Extracts under ``raw_dir``; the calendar spans the given days, or the years that the facts fall in."""
    return Warehouse(spark, raw_dir, "extracts", first_day, last_day)
