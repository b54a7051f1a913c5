"""Landing and typed reads of files (IO1, IO4, IO13).

Raw extracts are read with an explicit all-string schema (never ``inferSchema``), and
carry an ingest sequence so that keep-first dedupe follows file order. Records that do not fit
the header are set aside, with their place and text, and do not stop the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dedupe import ingest_sequence
from .schemas import CSV, PROCESSED, RAW_FILES, raw_schema

# Typed contracts of the KPI exports (as written by the KPI job).
EXPORTS = {
    "win_rate": "rep_name string, region string, territory string, month_year string, total_closed bigint, "
                "won bigint, win_rate double",
    "pipeline_velocity": "region string, month_year string, num_opportunities bigint, avg_deal_size double, "
                         "win_rate double, avg_cycle_days double, pipeline_velocity double",
    "quota_attainment": "rep_name string, region string, territory string, month_year string, "
                        "actual_revenue double, quota_amount double, quota_attainment double, "
                        "attainment_band string",
    "forecast_accuracy": "rep_name string, region string, month_year string, forecasted_rev double, "
                         "actual_revenue double, abs_error double, forecast_accuracy double, mape double",
    "mom_variance": "month_year string, total_revenue double, prev_revenue double, variance double, "
                    "variance_pct double",
    "territory_perf": "territory string, region string, total_opps bigint, won_opps bigint, win_rate double, "
                      "total_revenue double, avg_deal_size double, avg_cycle_days double",
}


#: A quoted field that ends a line still open: nothing but whole fields before it. Starting inside one is starting with its quote.
_OPEN = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'
#: A record of more lines than this in one split is not put together; it is rejected with its first ones.
MAX_RECORD_LINES = 10_000
#: Why a record was rejected is told by the record itself: this column holds its text, null for good ones.
REJECTED = "_rejected"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their place: file, block (the split's start), row (rises within a split)."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def _has_line_breaks(lines: DataFrame) -> bool:
    """Whether some quoted field goes over a line's end: unless one opens there, every line starts outside of one."""
    quoted = F.contains(F.col("value"), F.lit('"'))
    return not lines.where((quoted & F.col("value").rlike(_OPEN)) | F.rtrim(F.col("value"), F.lit("\r")).contains("\r")).isEmpty()


def _records(lines: DataFrame) -> DataFrame:
    """Records of CSV text whose quoted fields hold line breaks: record (text), n_lines, file, block, row (of its first line).

    A line maps "inside a quoted field" to the same question at its end: it keeps the state, swaps it, or ends in one
    whatever it began in. Each split composes its lines' maps; composing the splits' maps along a file gives the
    state, and the open record, that each split begins with. Only then are records that span lines brought together.
    """
    split, whole = Window.partitionBy("file", "block"), Window.partitionBy("file").orderBy("block")
    so_far = split.orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quoted = F.contains(F.col("value"), F.lit('"'))
    from_out = quoted & F.col("value").rlike(_OPEN)
    from_in = ~quoted | F.concat(F.lit('"'), F.col("value")).rlike(_OPEN)
    maps = lines.withColumns({"o": from_out, "i": from_in})
    # State after a line: what the last line of fixed end left, swapped as often as lines since then swap.
    swaps = maps.withColumn("swaps", F.sum((F.col("o") & ~F.col("i")).cast("int")).over(so_far))
    fixed = F.when(F.col("o") == F.col("i"), (F.col("o").cast("int") + F.col("swaps")) % 2)
    known = swaps.withColumn("fixed", F.last(fixed, True).over(so_far))
    ends = lambda start: ((F.coalesce("fixed", start) + F.col("swaps")) % 2) == 1
    after = known.withColumns({"after_out": ends(F.lit(0)), "after_in": ends(F.lit(1))}).drop("o", "i", "swaps", "fixed")
    before = split.orderBy("row")
    each = after.withColumns({
        "starts_out": ~F.lag("after_out", 1, False).over(before),  # whether a record starts here, by the split's first state
        "starts_in": ~F.lag("after_in", 1, True).over(before)}).drop("after_out", "after_in")
    ends_of = after.groupBy("file", "block").agg(
        F.max_by("after_out", "row").alias("o"), F.max_by("after_in", "row").alias("i"))
    firsts = each.groupBy("file", "block").agg(*[
        F.max(F.when(F.col(f"starts_{k}"), F.col("row"))).alias(f"last_{k}") for k in ("out", "in")])
    # One row per split, not per line.
    split_swaps = F.sum((F.col("o") & ~F.col("i")).cast("int")).over(whole)
    table = ends_of.join(firsts, ["file", "block"]).withColumn("swaps", split_swaps)
    split_fixed = F.when(F.col("o") == F.col("i"), (F.col("o").cast("int") + F.col("swaps")) % 2)
    table = table.withColumn("fixed", F.last(split_fixed, True).over(whole))
    table = table.withColumn("after", ((F.coalesce("fixed", F.lit(0)) + F.col("swaps")) % 2) == 1)
    table = table.withColumn("inside", F.lag("after", 1, False).over(whole))
    last = F.when(F.col("inside"), F.col("last_in")).otherwise(F.col("last_out"))
    earlier = whole.rowsBetween(Window.unboundedPreceding, -1)
    open_record = F.last(F.when(last.isNotNull(), F.struct("block", last.alias("row"))), True).over(earlier)
    table = table.select("file", "block", "inside", open_record.alias("open"))
    placed = each.join(table, ["file", "block"])
    starts = F.when(F.col("inside"), F.col("starts_in")).otherwise(F.col("starts_out"))
    own = F.last(F.when(starts, F.struct("block", "row")), True).over(so_far)
    placed = placed.withColumn("at", F.coalesce(own, F.col("open")))
    placed = placed.withColumn("nth", F.row_number().over(Window.partitionBy("file", "block", "at").orderBy("row")))
    text = F.when(F.col("nth") <= MAX_RECORD_LINES, F.struct("block", "row", "value"))
    grouped = placed.groupBy("file", "at").agg(
        F.array_sort(F.collect_list(text)).alias("parts"), F.count(F.lit(1)).alias("n_lines"))
    record = F.rtrim(F.array_join(F.transform("parts", lambda x: x["value"]), "\n"), F.lit("\r"))
    return grouped.select(record.alias("record"), "n_lines", F.size("parts").alias("n_parts"), "file", "at.block", "at.row")


def read_records(spark: SparkSession, raw_dir: str, name: str, path: str | None = None) -> DataFrame:
    """IO1: all records of one raw extract, its columns as strings, with ``_seq`` (ingest order) and ``_rejected``.

    Quotes follow RFC 4180: a doubled quote is a quote, and a quoted field may hold line breaks. Columns are mapped by
    the header's names; a header that lacks one is refused. A record with more or fewer fields than the header, or with
    an open quote at the file's end, has its text in ``_rejected``. Large files are read in splits: files without line
    breaks in fields by the CSV reader, others by lines that are put together again.
    """
    path = path or f"{raw_dir.rstrip('/')}/{RAW_FILES[name]}"
    wanted = [f.name for f in raw_schema(name).fields]
    header = spark.read.options(**CSV).option("multiLine", True).option("inferSchema", False).csv(path).columns
    missing = [c for c in wanted if c not in header]
    if missing:
        raise ValueError(f"extract {name} at {path} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, REJECTED]])
    options = {**CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED, "columnPruning": "false"}
    lines = _lines(spark, path)
    if not _has_line_breaks(lines):
        df = spark.read.schema(schema).options(**options).option("enforceSchema", False).csv(path)
        # The CSV reader refuses to read that column alone, as a count of it would.
        whole = F.concat(F.coalesce(header[0], F.lit("")), REJECTED)
        return df.select(*wanted, ingest_sequence().alias("_seq"), F.when(whole.isNotNull(), F.col(REJECTED)).alias(REJECTED))
    rows = _records(lines)
    first = Window.partitionBy("file").orderBy("block", "row")
    heads = rows.where("block = 0").withColumn("nth", F.row_number().over(first)).where("nth = 1").select("file", "block", "row")
    rows = rows.join(heads, ["file", "block", "row"], "left_anti").where("record <> '' OR n_lines > 1")
    fields = F.from_csv("record", schema.simpleString()[len("struct<"):-1].replace(":", " "), options | {"header": "false"})
    parsed = rows.withColumn("fields", fields).select(
        *[F.col(f"fields.{c}").alias(c) for c in wanted], F.struct("file", "block", "row").alias("_seq"),
        F.when((F.col("n_parts") < F.col("n_lines")) | F.col("record").rlike(_OPEN), F.col("record")).otherwise(F.col(f"fields.{REJECTED}")).alias(REJECTED))
    return parsed


def read_extract(spark: SparkSession, raw_dir: str, name: str, path: str | None = None) -> DataFrame:
    """IO1: the good records of one raw extract as strings (+ ``_seq`` ingest order); see ``read_records``, ``rejected``."""
    return accepted(read_records(spark, raw_dir, name, path))


def accepted(records: DataFrame) -> DataFrame:
    return records.where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected(records: DataFrame, name: str) -> DataFrame:
    """Quarantine rows: extract, file, block, row (its place), record (its text)."""
    return records.where(F.col(REJECTED).isNotNull()).select(
        F.lit(name).alias("extract"), "_seq.file", "_seq.block", "_seq.row", F.col(REJECTED).alias("record"))


def read_processed(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """IO4: a processed table by name. Parquet carries its own schema (ids keep their
    landed type); CSV is read with the table contract."""
    path = f"{root.rstrip('/')}/{name}"
    if fmt == "csv":
        return spark.read.schema(PROCESSED[name]).options(**CSV).option("multiLine", True).csv(path)
    return spark.read.parquet(path)


def read_export(spark: SparkSession, root: str, name: str) -> DataFrame:
    """IO13: typed read of a KPI export (CSV with header)."""
    schema = T._parse_datatype_string(EXPORTS[name])
    return spark.read.schema(schema).options(**CSV).option("multiLine", True).csv(f"{root.rstrip('/')}/{name}")
