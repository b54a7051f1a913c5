"""Adapter: the driver's TPC-H-like tables as the seven raw sales extracts.

The mapping (the oracle SQL uses the same rules):

* reps        supplier ⋈ nation ⋈ region: rep = supplier, region = region name,
              territory = nation name, manager = region name.
* products    part: category = p_type, unit price = p_retailprice, cost = price − 10·size.
* campaigns   distinct order priority; type 'a' when the priority sorts before '3', else 'b'
              (lower case and padded on purpose: the cleaning step normalises it).
* opportunities  lineitem ⋈ orders, one per line: id = orderkey·10 + linenumber (repeats
              in the data: the cleaning step keeps the first by part, supplier, ship date,
              price, quantity, …); created = order date; closed ⇔ linestatus 'F';
              won ⇔ closed and returnflag 'A'; close date = ship date when closed;
              open stage from returnflag N/R/A → Prospecting/Proposal/Negotiation;
              probability 100/0 when closed, else round(discount·1500) (may exceed 100);
              days = ship date − order date (may be negative).
              Deterministic dirt for the cleaning rules: open lines with tax > 0.075 get
              stage 'GARBAGE'; tax and discount both 0 give a negative deal value; tax 0
              with discount 0.1 on a closed line loses its close date.

Keys stay BIGINT (cheaper to hash and compare than formatted text ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dedupe import keep_first

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, listed anew for every plan, so that files written since are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # nation and region have a fixed size (25 and 5 rows) by the data's definition
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    r = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    return j.select(
        F.col("s_suppkey").alias("rep_id"),
        F.col("s_name").alias("rep_name"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("territory"),
        F.col("r_name").alias("manager"),
        F.date_add(F.lit("2018-01-01").cast("date"), (F.col("s_suppkey") % 1977).cast("int")).alias("hire_date"),
        F.struct(F.col("s_suppkey")).alias("_seq"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
        (F.col("p_retailprice") - F.lit(10.0) * F.col("p_size")).alias("cost_price"),
        F.struct(F.col("p_partkey")).alias("_seq"),
    )


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    pr = F.col("o_orderpriority")
    return o.select(
        pr.alias("campaign_id"),
        F.concat(F.lit("Campaign "), pr).alias("campaign_name"),
        F.when(pr < "3", F.lit(" a ")).otherwise(F.lit("b")).alias("campaign_type"),
        F.struct(pr).alias("_seq"),
    )


#: Order of the copies of an opportunity, as ``_seq``; what is left to tell rows apart follows.
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def opportunity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders: the columns that opportunities are made of, before they repeat in derived ones."""
    return _joined_lines(spark, sf_dir).drop("l_orderkey", "l_linenumber")


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_ORDER)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    return li.join(od, li.l_orderkey == od.o_orderkey).select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("opportunity_id"), *LINE_ORDER,
        "o_orderpriority", F.col("o_orderdate").cast("date").alias("created_date"))


def first_lines(lines: DataFrame) -> DataFrame:
    """One line per opportunity, the one that keep-first finds in the raw extract: by ``_seq``, then by campaign and
    creation date; all other columns of the extract follow from these. Rows of half the width meet in the shuffle."""
    return keep_first(lines, "opportunity_id", [*LINE_ORDER, "o_orderpriority", "created_date"])


def marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``opportunity_lines`` with ``is_first`` (of its order and line number, in the order of ``first_lines``) and ``shared``
    (the line number, null or not one digit, may give the id of another order's line). The join has brought orders together."""
    copies = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER, "o_orderpriority", "created_date")
    marks = {"is_first": F.row_number().over(copies) == 1, "shared": ~F.coalesce(F.col("l_linenumber").between(0, 9), F.lit(False))}
    return _joined_lines(spark, sf_dir).withColumns(marks).drop("l_orderkey", "l_linenumber")


def first_of_marked(lines: DataFrame) -> DataFrame:
    """``first_lines`` of stored ``marked_lines``: without a shuffle, unless two orders may share an id."""
    first = lines.where("is_first").drop("is_first", "shared")
    return first if lines.where("shared").isEmpty() else first_lines(first)


def first_opportunities(first: DataFrame) -> DataFrame:
    """The opportunities of first lines, each column computed once: without the step through ``inline`` the planner repeats the
    expressions wherever the cleaning rules use a column, in methods too long for the JIT compiler."""
    return first.select(F.inline(F.array(F.struct(*opportunity_columns()))))


def raw_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_opportunities(opportunity_lines(spark, sf_dir))


def as_opportunities(lines: DataFrame) -> DataFrame:
    return lines.select(*opportunity_columns())


def opportunity_columns() -> list[Column]:
    closed = F.col("l_linestatus") == "F"
    won = closed & (F.col("l_returnflag") == "A")
    tax, disc = F.col("l_tax"), F.col("l_discount")
    ship = F.col("l_shipdate").cast("date")
    created = F.col("created_date")
    stage = (
        F.when(won, "Closed Won")
        .when(closed, "Closed Lost")
        .when(tax > 0.075, "GARBAGE")
        .when(F.col("l_returnflag") == "N", "Prospecting")
        .when(F.col("l_returnflag") == "R", "Proposal")
        .otherwise("Negotiation")
    )
    price = F.col("l_extendedprice")
    return [
        F.col("opportunity_id"),
        F.col("l_suppkey").alias("rep_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderpriority").alias("campaign_id"),
        created,
        F.when(closed & ~((tax < 0.005) & (disc > 0.095)), ship).alias("close_date"),
        stage.alias("stage"),
        F.when((tax < 0.005) & (disc < 0.005), -price).otherwise(price).alias("deal_value"),
        F.when(won, F.lit(100.0)).when(closed, F.lit(0.0)).otherwise(F.round(disc * 1500.0)).alias("probability"),
        F.datediff(ship, created).alias("days_in_pipeline"),
        F.when(won, 1).otherwise(0).alias("is_won"),
        F.when(closed, 1).otherwise(0).alias("is_closed"),
        F.struct(*LINE_ORDER).alias("_seq"),
    ]


def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar span of the data: 1 January of the first order year to 31 December of
    the last ship year (one row: start, end)."""
    o = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("lo"), F.lit(1).alias("_one"))
    li = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("hi"), F.lit(1).alias("_one"))
    return o.join(li, "_one").select(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("end"))
