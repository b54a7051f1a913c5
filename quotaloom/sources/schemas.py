"""Table contracts: one StructType per table.

Raw extracts land as all-string columns (bad values must become null later, never
errors, and ``inferSchema`` would turn 'YYYY-MM' into timestamps). Processed tables
carry business types: money DECIMAL(18,2), dates DATE, flags INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Column lists of the seven raw extracts, in file order.
RAW_COLUMNS = {
    "reps": ["rep_id", "rep_name", "region", "territory", "manager", "hire_date"],
    "opportunities": [
        "opportunity_id", "rep_id", "product_id", "campaign_id", "created_date", "close_date", "stage",
        "deal_value", "probability", "days_in_pipeline", "is_won", "is_closed",
    ],
    "revenue": ["revenue_id", "opportunity_id", "rep_id", "product_id", "close_date", "revenue", "month_year"],
    "quotas": ["quota_id", "rep_id", "month_year", "quota_amount"],
    "forecasts": ["forecast_id", "rep_id", "month_year", "forecasted_rev", "forecast_date"],
    "products": ["product_id", "product_name", "category", "unit_price", "cost_price"],
    "campaigns": ["campaign_id", "campaign_name", "campaign_type"],
}

# File names of the raw extracts.
RAW_FILES = {
    "reps": "crm_reps.csv",
    "opportunities": "crm_opportunities.csv",
    "revenue": "erp_revenue.csv",
    "quotas": "quota_targets.csv",
    "forecasts": "revenue_forecasts.csv",
    "products": "product_catalog.csv",
    "campaigns": "campaigns.csv",
}


def raw_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS[name]])


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, I, DB = T.StringType(), T.DateType(), T.IntegerType(), T.DoubleType()

# CSV as RFC 4180 has it: a header, and a doubled quote for a quote.
CSV = {"header": "true", "quote": '"', "escape": '"'}
# Facts stored partitioned by month so month filters prune files.
PARTITIONS = {"fact_revenue": ["month_year"], "fact_quotas": ["month_year"], "fact_forecasts": ["month_year"]}

PROCESSED = {
    "dim_reps": _s(("rep_id", S), ("rep_name", S), ("region", S), ("territory", S), ("manager", S), ("hire_date", D)),
    "dim_products": _s(("product_id", S), ("product_name", S), ("category", S), ("unit_price", MONEY),
                       ("cost_price", MONEY), ("margin_pct", DB)),
    "dim_campaigns": _s(("campaign_id", S), ("campaign_name", S), ("campaign_type", S)),
    "dim_date": _s(("date_id", S), ("year", I), ("quarter", I), ("month", I), ("month_name", S), ("week", I),
                   ("day_of_week", I), ("is_weekday", I)),
    "fact_opportunities": _s(("opportunity_id", S), ("rep_id", S), ("product_id", S), ("campaign_id", S),
                             ("created_date", D), ("close_date", D), ("stage", S), ("deal_value", MONEY),
                             ("probability", DB), ("days_in_pipeline", I), ("is_won", I), ("is_closed", I),
                             ("weighted_value", DB)),
    "fact_revenue": _s(("revenue_id", S), ("opportunity_id", S), ("rep_id", S), ("product_id", S),
                       ("close_date", D), ("revenue", MONEY), ("month_year", S)),
    "fact_quotas": _s(("quota_id", S), ("rep_id", S), ("month_year", S), ("quota_amount", MONEY)),
    "fact_forecasts": _s(("forecast_id", S), ("rep_id", S), ("month_year", S), ("forecasted_rev", MONEY),
                         ("forecast_date", D)),
}

# Declared keys of the warehouse (checked by the data-quality job, never enforced on write).
PRIMARY_KEYS = {
    "dim_reps": "rep_id", "dim_products": "product_id", "dim_campaigns": "campaign_id", "dim_date": "date_id",
    "fact_opportunities": "opportunity_id", "fact_revenue": "revenue_id", "fact_quotas": "quota_id",
    "fact_forecasts": "forecast_id",
}
NOT_NULL = {
    "dim_reps": ["rep_name", "region", "territory"],
    "fact_opportunities": ["rep_id"],
    "fact_revenue": ["rep_id"],
    "fact_quotas": ["rep_id"],
    "fact_forecasts": ["rep_id"],
}
FOREIGN_KEYS = [
    ("fact_opportunities", "rep_id", "dim_reps", "rep_id"),
    ("fact_opportunities", "product_id", "dim_products", "product_id"),
    ("fact_opportunities", "campaign_id", "dim_campaigns", "campaign_id"),
    ("fact_revenue", "opportunity_id", "fact_opportunities", "opportunity_id"),
    ("fact_revenue", "rep_id", "dim_reps", "rep_id"),
    ("fact_revenue", "product_id", "dim_products", "product_id"),
    ("fact_quotas", "rep_id", "dim_reps", "rep_id"),
    ("fact_forecasts", "rep_id", "dim_reps", "rep_id"),
]


def ddl(name: str, fmt: str = "parquet", stored: T.StructType | None = None, full_name: str | None = None) -> str:
    """CREATE TABLE statement of a processed table, under ``full_name`` if given; column types as ``stored`` where it has
    them (ids keep the type they landed with), partitioned as the ETL writes it."""
    types = {f.name: f.dataType for f in (stored or PROCESSED[name]).fields}
    cols = ", ".join(f"{f.name} {types.get(f.name, f.dataType).simpleString().upper()}" for f in PROCESSED[name].fields)
    options = f" OPTIONS ({', '.join(f'{k} {_quoted(v)}' for k, v in CSV.items())})" if fmt == "csv" else ""
    parts = f" PARTITIONED BY ({', '.join(PARTITIONS[name])})" if name in PARTITIONS else ""
    return f"CREATE TABLE {full_name or name} ({cols}) USING {fmt}{options}{parts}"


def _quoted(v: str) -> str:
    return "'" + v + "'"
