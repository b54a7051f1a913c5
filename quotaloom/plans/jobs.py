"""Jobs: full-refresh ETL, KPI suite, A/B tests, forecasting, report datasets, views.

The ETL job writes each processed table and re-reads it as the input of the tables
derived from it (revenue from opportunities, forecasts from revenue, quotas from reps):
the written table cuts the lineage, so a lost executor only recomputes the stage it was
in, and the expensive line ⋈ order join + dedupe runs once. Row counts in/out of every
cleaning step are collected with ``observe()`` during the same writes. The tables go to a folder
of the run's own and become visible together, by one commit at the end (``sources.versions``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, experiments as ab, forecast as fc, kpis, reports as rp
from ..session import ensure_checkpoint_dir
from ..sources import landing, sinks, testdata, versions
from ..sources.schemas import PARTITIONS, PROCESSED, ddl
from .warehouse import Warehouse, from_extracts, from_testdata

RAW_OF = {"dim_reps": "reps", "dim_products": "products", "dim_campaigns": "campaigns",
          "fact_opportunities": "opportunities", "fact_revenue": "revenue", "fact_quotas": "quotas",
          "fact_forecasts": "forecasts"}


# Write waves: tables in one wave are independent and are written concurrently (one
# Spark job each, submitted from a thread pool); later waves read tables written before.
WAVES = [["fact_opportunities", "dim_reps", "dim_products", "dim_campaigns", "dim_date"],
         ["fact_revenue", "fact_quotas"],
         ["fact_forecasts"]]
CLEANERS = {"dim_reps": clean.clean_reps, "dim_products": clean.clean_products,
            "dim_campaigns": clean.clean_campaigns, "fact_opportunities": clean.clean_opportunities,
            "fact_revenue": clean.clean_revenue, "fact_quotas": clean.clean_quotas,
            "fact_forecasts": clean.clean_forecasts}


def etl_job(spark: SparkSession, source: str, dst: str, kind: str = "testdata", fmt: str = "parquet",
            timings: dict | None = None, parallel: int = 4, first_day: str | None = None,
            last_day: str | None = None) -> DataFrame:
    """IO14: extract → transform → load, full replace. Returns the DQ row-count table;
    ``timings`` (if given) receives seconds per table write. The days bound the calendar of
    extracts; without them it follows the data.

    Malformed records of an extract are counted as rejected (and dropped), and kept as the version's
    ``rejected_<extract>``. All eight tables are published by one commit. A run that fails or dies before it leaves the version
    before as it was, and readers that opened that version keep reading it; ``versions.prune`` removes old ones."""
    from concurrent.futures import ThreadPoolExecutor

    started = time.time()
    w = from_testdata(spark, source) if kind == "testdata" else from_extracts(spark, source, first_day, last_day)
    base, folder = versions.current(spark, dst), versions.new_run()
    own = f"{dst.rstrip('/')}/{folder}"
    stored = Warehouse(spark, own, "tables", fmt=fmt)
    counts: dict = {}
    records: dict[str, DataFrame] = {}
    rejects: dict[str, str] = {}

    def plan(table: str) -> DataFrame:
        if table not in RAW_OF:
            return w.dates
        label = RAW_OF[table]
        # derived extracts read the tables already written instead of recomputing them
        base = None if kind == "extracts" else (
            _derived_raw(w, stored, label) if label in ("revenue", "forecasts", "quotas") else w.raw(label))
        obs_in, obs_out = Observation(f"in_{label}"), Observation(f"out_{label}")
        counts[label] = {"in": obs_in, "out": obs_out}
        if kind == "extracts":  # counted before malformed records are set aside, in the same pass
            records[label] = landing.read_records(spark, source, label)
            met = records[label].observe(obs_in, F.count(F.lit(1)).alias("rows"), F.count(landing.REJECTED).alias("rejected"))
            seen = landing.accepted(met)
        else:
            seen = base.observe(obs_in, F.count(F.lit(1)).alias("rows"), F.count(F.lit(None)).alias("rejected"))
        derived = kind == "testdata" and label in ("revenue", "quotas", "forecasts")
        cleaned = CLEANERS[table](seen, unique=True) if derived else CLEANERS[table](seen)
        return cleaned.observe(obs_out, F.count(F.lit(1)).alias("rows"))

    def write(table: str) -> None:
        t0 = time.time()
        sinks.write_table(plan(table), f"{own}/{table}", "fail", fmt, PARTITIONS.get(table))
        if timings is not None:
            timings[table] = round(time.time() - t0, 3)

    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for wave in WAVES:
                list(pool.map(write, wave))  # re-raises the first failure
        tables = {t: [f"{folder}/{t}"] for wave in WAVES for t in wave}
        for label, found in records.items():
            if counts[label]["in"].get["rejected"]:
                landing.rejected(found, label).write.parquet(f"{own}/rejected_{label}")
                rejects[f"rejected_{label}"] = f"{folder}/rejected_{label}"
        versions.commit(spark, dst, base, fmt, tables, rejects)
    except BaseException:
        versions.discard(spark, dst, folder)
        raise
    rows = [(k, int(counts[k]["in"].get["rows"]), int(counts[k]["out"].get["rows"]), int(counts[k]["in"].get["rejected"]))
            for k in ("reps", "products", "campaigns", "opportunities", "revenue", "quotas", "forecasts")]
    dq = spark.createDataFrame(rows, "label string, rows_in bigint, rows_out bigint, rejected bigint")
    dq = dq.select("label", "rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("dropped"), "rejected")
    spark.conf.set("quotaloom.etl.seconds", f"{time.time() - started:.3f}")
    return dq


def extract_job(spark: SparkSession, source: str, raw_dir: str) -> list[str]:
    """IO2: write the seven raw extracts as CSV (header row, all text), as the source
    systems would deliver them. Each extract is range-partitioned and sorted on its key
    and ingest order, so file order is the order keep-first dedupe must honour.

    The line ⋈ order join and the bookings are stored once, in a folder of the run's own that goes at its end: three
    extracts come from the first and two from the second, and none is computed from the tables again."""
    from ..sources.schemas import RAW_COLUMNS, RAW_FILES
    w = from_testdata(spark, source)
    keys = {"reps": "rep_id", "opportunities": "opportunity_id", "revenue": "revenue_id", "quotas": "quota_id",
            "forecasts": "forecast_id", "products": "product_id", "campaigns": "campaign_id"}
    shared, own = ensure_checkpoint_dir(spark).rstrip("/"), f"extract-{uuid.uuid4().hex}"

    def stored(df: DataFrame, name: str) -> DataFrame:
        sinks.write_table(df, f"{shared}/{own}/{name}", "fail")
        return spark.read.schema(df.schema).parquet(f"{shared}/{own}/{name}")

    paths = []
    try:
        w.lines = stored(testdata.marked_lines(spark, source), "lines")
        w.opportunities = clean.clean_opportunities(testdata.first_opportunities(testdata.first_of_marked(w.lines)), unique=True)
        w._raw["revenue"] = stored(w.raw("revenue"), "bookings")
        for name, cols in RAW_COLUMNS.items():
            if name == "opportunities":  # lines are half as wide as the opportunities with their order
                order = ["opportunity_id", *testdata.LINE_ORDER]
                df = testdata.as_opportunities(w.lines.repartitionByRange("opportunity_id").sortWithinPartitions(*order))
            else:
                df = w.raw(name)
                order = [keys[name], "_seq"] if "_seq" in df.columns else [keys[name]]
                df = df.repartitionByRange(keys[name]).sortWithinPartitions(*order)
            out = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            path = f"{raw_dir.rstrip('/')}/{RAW_FILES[name]}"
            sinks.write_csv(out, path)
            paths.append(path)
    finally:
        versions.discard(spark, shared, own)
    return paths


def _derived_raw(w: Warehouse, stored: Warehouse, label: str) -> DataFrame:
    from ..operators import derive
    from .warehouse import ADAPTER_FIRST_MONTH, ADAPTER_LAST_MONTH, adapter_forecasts
    if w.kind == "extracts":
        return w.raw(label)
    if label == "revenue":
        return derive.derive_bookings(stored.opportunities)
    if label == "forecasts":
        return adapter_forecasts(stored.revenue)
    amount = F.lit(80000.0) + F.lit(1000.0) * (F.col("rep_id") % 40)
    return derive.quota_spine(stored.reps, ADAPTER_FIRST_MONTH, ADAPTER_LAST_MONTH, amount)


def kpi_suite(w: Warehouse) -> dict[str, DataFrame]:
    """IO15: the six exported KPIs by name (lazy)."""
    return {
        "win_rate": kpis.win_rate(w.opportunities, w.reps, "rep_month"),
        "pipeline_velocity": kpis.pipeline_velocity(w.opportunities, w.reps),
        "quota_attainment": kpis.quota_attainment(w.quotas, w.reps, w.revenue),
        "forecast_accuracy": kpis.forecast_accuracy(w.forecasts, w.reps, w.revenue),
        "mom_variance": kpis.mom_variance(w.revenue),
        "territory_perf": kpis.territory_performance(w.opportunities, w.reps),
    }


def kpi_job(spark: SparkSession, warehouse_dir: str, out: str, fmt: str = "parquet") -> list[str]:
    """IO9: compute and export the six KPI tables (CSV with header). ``fmt``, here and in the jobs below, is the
    format of a warehouse folder without commits; a committed version knows its own."""
    w = Warehouse(spark, warehouse_dir, "tables", fmt=fmt)
    return sinks.publish({n: kpis.for_export(n, df) for n, df in kpi_suite(w).items()}, out, "csv")


def ab_job(spark: SparkSession, warehouse_dir: str, out: str, fmt: str = "parquet") -> list[str]:
    """IO11: campaign summary, t-test (+ effect size) and chi-square result sets."""
    w = Warehouse(spark, warehouse_dir, "tables", fmt=fmt)
    d = ab.ab_dataset(w.opportunities, w.campaigns)
    m = ab.campaign_moments(w.opportunities, w.campaigns)
    t = ab.ab_welch_ttest_p(m).withColumn("_one", F.lit(1)).join(
        ab.ab_effect_size(m).withColumn("_one", F.lit(1)), "_one").drop("_one")
    return sinks.publish({"campaign_summary": ab.campaign_summary(d), "t_test_results": t,
                          "chi_square_results": ab.ab_chi_square_p(m)}, out, "csv")


def forecast_job(spark: SparkSession, warehouse_dir: str, out: str, horizon: int = 3,
                 fmt: str = "parquet") -> list[str]:
    """IO10: company-level revenue forecast (month_year, forecasted_revenue)."""
    w = Warehouse(spark, warehouse_dir, "tables", fmt=fmt)
    f = fc.holt_forecast(w.revenue, [], "revenue", horizon).select("month_year", "forecasted_revenue")
    return sinks.publish({"revenue_forecast": f}, out, "csv")


def report_job(spark: SparkSession, warehouse_dir: str, out: str, fmt: str = "parquet") -> list[str]:
    """IO12: executive summary + six KPI sheets (quota sheet without the band column)."""
    w = Warehouse(spark, warehouse_dir, "tables", fmt=fmt)
    k = kpi_suite(w)
    sheets = {"executive_summary": rp.report_summary(k["win_rate"], k["quota_attainment"], k["forecast_accuracy"],
                                                      w.revenue),
              **{n: kpis.for_export(n, df.drop("attainment_band") if n == "quota_attainment" else df)
                 for n, df in k.items()}}
    return sinks.publish(sheets, out, "csv")


def _catalog_entry(spark: SparkSession, name: str) -> dict[str, str] | None:
    """Type, provider, location and columns of a catalog table or view, None if there is none; temporary views do not count."""
    if not spark.catalog.tableExists(name):
        return None
    out, columns = {}, []
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect():
        if r.col_name.startswith("#") or not r.col_name:
            out.setdefault("Columns", ", ".join(columns))
        elif "Columns" not in out:
            columns.append(f"{r.col_name} {r.data_type}")
        else:
            out.setdefault(r.col_name, r.data_type)
    return out


def create_schema(spark: SparkSession, location: str, fmt: str = "parquet") -> list[str]:
    """IO6: declare the eight processed tables in the current database, by their full names.

    They stand at the folders of the current version of ``location``, or at ``location``/<table> where nothing was
    committed. A table already written there is declared with its own column types and its partitions are found;
    others get the contract schema. A table declared earlier at another place, as another format or with other columns
    is declared anew: it is external, so its files stay. A managed table or a view of the same name is refused. A
    table with several folders (appended loads) becomes a view over them. Declared keys are checked by the DQ job
    (``dq_constraints``), not enforced on write.
    """
    from pyspark.errors import AnalysisException

    version, database = versions.current(spark, location), spark.catalog.currentDatabase()
    fmt = version.fmt if version else fmt
    for name in PROCESSED:
        full = f"spark_catalog.`{database}`.`{name}`"
        folders = version.folders(location, name) if version else [f"{location.rstrip('/')}/{name}"]
        had = _catalog_entry(spark, full)
        if had and had.get("Type") != "EXTERNAL" and not (had.get("Type") == "VIEW" and _OWN_VIEW in had.get("Table Properties", "")):
            raise ValueError(f"{full} is a {had.get('Type', 'table').lower()} that this job did not declare")
        try:
            written = spark.read.format(fmt).load(folders[0]).schema
        except AnalysisException:  # nothing written yet
            written = None
        if had:  # of a table whose partitions stand elsewhere, each partition would have to move: declare it anew
            spark.sql(f"DROP {'VIEW' if had['Type'] == 'VIEW' else 'TABLE'} {full}")
        if len(folders) > 1:
            if fmt == "csv":
                raise ValueError(f"{name}: a CSV table of several loads has no typed view; replace it by one load")
            rows = " UNION ALL ".join(f"SELECT {', '.join(PROCESSED[name].names)} FROM parquet.`{f}`" for f in folders)
            spark.sql(f"CREATE VIEW {full} TBLPROPERTIES ('{_OWN_VIEW}' = 'true') AS {rows}")
            continue
        spark.sql(f"{ddl(name, fmt, written if fmt != 'csv' else None, full)} LOCATION '{folders[0]}'")
        if name in PARTITIONS and written is not None:
            spark.catalog.recoverPartitions(full)
    return list(PROCESSED)


#: Property of the views that stand for tables of several folders.
_OWN_VIEW = "quotaloom.folders"


def create_views(spark: SparkSession, w: Warehouse) -> list[str]:
    """IO7: the three reporting views of the session, and its tables as ``wh_<table>``, so that catalog tables stay visible."""
    views = {f"wh_{name}": df for name, df in w.tables().items()}
    views |= {"vw_exec_kpi_summary": kpis.exec_kpi_summary(w.opportunities, w.reps, w.revenue, w.quotas),
              "vw_pipeline_health": kpis.pipeline_health(w.opportunities, w.reps),
              "vw_campaign_performance": kpis.campaign_performance(w.opportunities, w.campaigns)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """IO8: SQL text in, DataFrame out."""
    return spark.sql(sql)


def run_all(spark: SparkSession, source: str, root: str, kind: str = "testdata",
            via_files: bool = False, fmt: str = "parquet") -> dict[str, Callable]:
    """Full refresh then every downstream job; one failure does not stop the rest, but the run ends by raising it.
    ``via_files`` lands the driver tables as CSV extracts first (extract → transform → load)."""
    wh = f"{root.rstrip('/')}/warehouse"
    results: dict = {}
    if via_files and kind == "testdata":
        raw = f"{root.rstrip('/')}/raw"
        results["extract"] = extract_job(spark, source, raw)
        source, kind = raw, "extracts"
    results["etl"] = etl_job(spark, source, wh, kind, fmt)
    failed: dict[str, Exception] = {}
    for name, job in (("kpi", kpi_job), ("ab", ab_job), ("forecast", forecast_job), ("report", report_job)):
        try:
            results[name] = job(spark, wh, f"{root.rstrip('/')}/exports/{name}")
        except Exception as e:  # noqa: BLE001 — per-job isolation like a scheduler would give
            failed[name] = e
    if failed:
        raise ExceptionGroup(f"jobs failed: {', '.join(failed)}", list(failed.values()))
    return results
