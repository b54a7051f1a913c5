"""quotaloom — sales-operations analytics as Spark DataFrame/SQL jobs.

Layers:
  sources/    landing of extracts, table contracts, driver-table adapter, sinks
  functions/  reusable column expressions and distributed helpers
  operators/  cleaning, derivations, KPIs, measures, experiments, forecasting, reports
  plans/      warehouse assembly (star schema), jobs, query registry
"""

__version__ = "0.1.0"
