"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Two phases, as the pipeline runs in production:
  etl      full refresh: driver tables → cleaned star schema written as parquet (timed once)
  queries  headline KPI / view / experiment / forecast queries over the written warehouse,
           plus the end-to-end flagship (raw tables → result) — each warm, median of 3.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quotaloom.operators import experiments as ab  # noqa: E402
from quotaloom.operators import forecast as fc  # noqa: E402
from quotaloom.operators import kpis  # noqa: E402
from quotaloom.operators import measures as M  # noqa: E402
from quotaloom.plans import jobs  # noqa: E402
from quotaloom.plans.registry import QUERIES, region_monthly  # noqa: E402
from quotaloom.plans.warehouse import Warehouse  # noqa: E402
from quotaloom.session import ensure_checkpoint_dir, local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def headline(w: Warehouse):
    model = M.Model(w.opportunities, w.revenue, w.quotas, w.forecasts, w.reps)
    d = ab.ab_dataset(w.opportunities, w.campaigns)
    m = ab.campaign_moments(w.opportunities, w.campaigns)  # as the registered queries and the A/B job do
    return {
        "win_rate_rep_month": lambda: kpis.win_rate(w.opportunities, w.reps, "rep_month"),
        "pipeline_velocity": lambda: kpis.pipeline_velocity(w.opportunities, w.reps),
        "quota_attainment": lambda: kpis.quota_attainment(w.quotas, w.reps, w.revenue),
        "forecast_accuracy": lambda: kpis.forecast_accuracy(w.forecasts, w.reps, w.revenue),
        "mom_variance": lambda: kpis.mom_variance(w.revenue),
        "territory_performance": lambda: kpis.territory_performance(w.opportunities, w.reps),
        "territory_summary_fanout": lambda: kpis.territory_summary_fanout(w.opportunities, w.reps, w.revenue),
        "exec_kpi_summary": lambda: kpis.exec_kpi_summary(w.opportunities, w.reps, w.revenue, w.quotas),
        "pipeline_health": lambda: kpis.pipeline_health(w.opportunities, w.reps),
        "campaign_summary": lambda: ab.campaign_summary(d),
        "ab_welch_ttest_p": lambda: ab.ab_welch_ttest_p(m),
        "ab_chi_square_p": lambda: ab.ab_chi_square_p(m),
        "m_quota_attainment": lambda: M.evaluate(model, ["region", "month_year"], ["quota_attainment"]),
        "holt_forecast_region": lambda: fc.holt_forecast(region_monthly(w), ["region"], "revenue", 3),
    }


#: Registered queries timed as the driver checks them, from the raw tables.
FROM_RAW = ["win_rate_rep_month", "report_findings", "dq_constraints", "exec_kpi_summary", "ab_tests_grouped", "holt_forecast"]


def timed(fn) -> float:
    t = time.perf_counter()
    df = fn()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    spark = local_session(CPUS, "quotaloom-bench")
    # scratch under the session's checkpoint folder (shared storage on a cluster; a fresh
    # local folder only when the session names none)
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    wh = f"{scratch}/warehouse"
    # warm-up: the same ETL code path on the smallest tables (JIT, codegen caches)
    jobs.etl_job(spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001"), f"{scratch}/warmup")
    t = time.perf_counter()
    etl_tables: dict = {}
    jobs.etl_job(spark, SF_DIR, wh, timings=etl_tables)
    etl = time.perf_counter() - t
    w = Warehouse(spark, wh, "tables")
    per = {}
    for name, fn in headline(w).items():
        timed(fn)  # warm-up
        per[name] = statistics.median(timed(fn) for _ in range(RUNS))
    for name in FROM_RAW:
        timed(lambda: QUERIES[name](spark, SF_DIR))
        per[f"{name}_from_raw"] = statistics.median(timed(lambda: QUERIES[name](spark, SF_DIR)) for _ in range(RUNS))
    per = {k: round(v, 3) for k, v in per.items()}
    total = round(sum(per.values()), 3)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": total, "unit": "sec",
                      "queries": per, "etl_sec": round(etl, 3), "etl_tables": etl_tables, "sf": SF_DIR.rstrip("/").split("sf")[-1],
                      "cpus": CPUS, "runs": RUNS}))


if __name__ == "__main__":
    main()
