"""Data rules of the extraction step (the random simulator itself is not rebuilt).

DV1 bookings from won opportunities, DV2 rep × month quota grid, DV3 monthly revenue
per rep as the forecast baseline, DV4 opportunity state as of a date, DV5 source profile.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import month_key, month_start
from ..functions.numbering import number_rows


def derive_bookings(opps: DataFrame) -> DataFrame:
    """DV1: one booking per won opportunity; revenue = deal value; month from close date.

    The booking id is the opportunity id (a deterministic key), so that no sort is needed;
    ``number_bookings`` gives the numbers in input order.
    """
    won = opps.filter(F.col("is_won") == 1)
    return won.select(
        F.col("opportunity_id").alias("revenue_id"),
        "opportunity_id", "rep_id", "product_id", "close_date",
        F.col("deal_value").alias("revenue"),
        month_key("close_date").alias("month_year"),
    )


def number_bookings(bookings: DataFrame, order: Sequence[str] = ("opportunity_id",)) -> DataFrame:
    """DV1: bookings with ``revenue_id`` REV0001, REV0002 … in the order of ``order`` (four digits or more)."""
    numbered = number_rows(bookings, order, "_number")
    digits = F.col("_number").cast("string")
    padded = F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))
    return numbered.withColumn("revenue_id", F.concat(F.lit("REV"), padded)).drop("_number")


def quota_spine(reps: DataFrame, start_month: str, end_month: str, amount: Column) -> DataFrame:
    """DV2: one quota row per rep and month in [start_month, end_month] ('yyyy-MM').

    The month list is generated per rep row (``explode(sequence)``): no join. Reps are few bytes and their grid is
    many, so they are dealt round robin to a fixed number of partitions first: merged by size (or dealt by their id again,
    which the planner drops), they would leave the whole grid, and what is grouped on it, to one task.
    """
    reps = reps.select("rep_id").repartition(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    months = F.sequence(F.lit(f"{start_month}-01").cast("date"), F.lit(f"{end_month}-01").cast("date"),
                        F.expr("INTERVAL 1 MONTH"))
    g = reps.select("rep_id", F.explode(months).alias("_m"))
    g = g.withColumn("month_year", F.date_format("_m", "yyyy-MM"))
    return g.select(
        F.concat_ws("-", F.col("rep_id").cast("string"), F.col("month_year")).alias("quota_id"),
        "rep_id", "month_year",
        amount.alias("quota_amount"),
    )


def forecast_baseline(revenue: DataFrame) -> DataFrame:
    """DV3: revenue per rep and month; forecast_date = first day of the previous month."""
    g = revenue.groupBy("rep_id", "month_year").agg(F.sum("revenue").alias("revenue"))
    return g.withColumn("forecast_date", F.add_months(month_start("month_year"), -1))


def opp_lifecycle(df: DataFrame, as_of: str) -> DataFrame:
    """DV4: state of each opportunity as of a date.

    Input columns: created_date, planned_close_date, wins (0/1), open_stage. A planned
    close after ``as_of`` means still open: no close date, flags 0, age as of the date;
    otherwise closed: stage Closed Won/Lost, probability 100/0, days = cycle length.
    """
    asof = F.lit(as_of).cast("date")
    is_open = F.col("planned_close_date") > asof
    won = (~is_open) & (F.col("wins") == 1)
    return df.select(
        *[c for c in df.columns if c not in ("planned_close_date", "wins", "open_stage", "open_probability")],
        F.when(~is_open, F.col("planned_close_date")).alias("close_date"),
        F.when(is_open, F.col("open_stage")).when(won, "Closed Won").otherwise("Closed Lost").alias("stage"),
        F.when(is_open, F.col("open_probability")).when(won, F.lit(100.0)).otherwise(F.lit(0.0)).alias("probability"),
        F.when(is_open, F.datediff(asof, F.col("created_date")))
        .otherwise(F.datediff(F.col("planned_close_date"), F.col("created_date"))).alias("days_in_pipeline"),
        won.cast("int").alias("is_won"),
        (~is_open).cast("int").alias("is_closed"),
    )


def source_profile(reps: DataFrame, opps: DataFrame, revenue: DataFrame, quotas: DataFrame,
                   forecasts: DataFrame, extra: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """DV5: row counts per source, overall win rate of opportunities, total revenue."""
    parts = [
        reps.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("reps").alias("source"), F.lit("rows").alias("metric"), "value"),
        opps.agg(F.count(F.lit(1)).cast("double").alias("n"),
                 (F.sum("is_won").cast("double") / F.count("is_won")).alias("wr")).select(
            F.lit("opportunities").alias("source"),
            F.explode(F.array(F.struct(F.lit("rows").alias("metric"), F.col("n").alias("value")),
                              F.struct(F.lit("win_rate").alias("metric"), F.col("wr").alias("value")))).alias("kv"),
        ).select("source", "kv.metric", "kv.value"),
        revenue.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("revenue").cast("double").alias("s")).select(
            F.lit("revenue").alias("source"),
            F.explode(F.array(F.struct(F.lit("rows").alias("metric"), F.col("n").alias("value")),
                              F.struct(F.lit("total").alias("metric"), F.col("s").alias("value")))).alias("kv"),
        ).select("source", "kv.metric", "kv.value"),
        quotas.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("quotas").alias("source"), F.lit("rows").alias("metric"), "value"),
        forecasts.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("forecasts").alias("source"), F.lit("rows").alias("metric"), "value"),
    ]
    for name, df in (extra or {}).items():
        parts.append(df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit(name).alias("source"), F.lit("rows").alias("metric"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
