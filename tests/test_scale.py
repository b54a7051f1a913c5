"""What grows with the data is spread over tasks, carried once and computed once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quotaloom.functions.dedupe import keep_first
from quotaloom.operators import derive, forecast as fc
from quotaloom.plans import jobs, registry
from quotaloom.plans.warehouse import from_testdata
from quotaloom.sources import sinks, testdata, versions

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def _line(order, part, number, price=10.0, flag="A"):
    return (order, part, 1, number, 1.0, price, 0.05, 0.02, flag, "F", dt.datetime(1995, 3, 1))


#: Repeated and null line numbers, and numbers of two digits that give another order's id (1 * 10 + 12 = 2 * 10 + 2).
LINES = [_line(1, 7, 1), _line(1, 5, 1), _line(1, 5, 1), _line(1, 9, 12), _line(2, 8, 2), _line(2, 3, 3, flag="R"), _line(2, 4, 3),
         _line(1, 6, None), _line(2, 2, None), _line(3, 1, 1), _line(9, 1, 1)]
ORDERS = [(1, dt.datetime(1995, 1, 2), "2-HIGH"), (1, dt.datetime(1995, 1, 1), "1-URGENT"), (2, dt.datetime(1995, 2, 1), "5-LOW"), (3, None, None)]


def _tables(spark, folder, lines):
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(ORDERS, "o_orderkey long, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("lines", [LINES, [x for x in LINES if x[3] and x[3] < 10], []])
def test_first_lines_are_those_that_keep_first_finds_in_the_extract(spark, tmp_out, lines):
    folder = _tables(spark, tmp_out, lines)
    raw = testdata.raw_opportunities(spark, folder)
    want = sorted(map(str, keep_first(raw, "opportunity_id", ["_seq"]).collect()))
    first = testdata.first_opportunities(testdata.first_lines(testdata.opportunity_lines(spark, folder)))
    testdata.marked_lines(spark, folder).write.parquet(f"{folder}/marked")
    marked = testdata.first_opportunities(testdata.first_of_marked(spark.read.parquet(f"{folder}/marked")))
    assert sorted(map(str, first.collect())) == want
    assert sorted(map(str, marked.collect())) == want


def test_keep_first_carries_its_order_once(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, 3, "0"), (None, 1, "x")], "k int, o int, v string")
    out = keep_first(df, "k", ["o"])
    assert out.columns == ["k", "o", "v"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, 2, "a"), (None, 1, "x")]
    buffer = next(f for f in keep_first(df, "k", ["o"])._jdf.queryExecution().analyzed().toString().splitlines() if "min(struct" in f)
    assert buffer.count("o#") == buffer.count("v#"), buffer  # once in the order, not again beside it


def _parts(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_quota_grid_is_spread(spark):
    reps = spark.range(200).withColumnRenamed("id", "rep_id").groupBy("rep_id").count()
    grid = derive.quota_spine(reps, "1995-01", "2001-12", F.col("rep_id") * 1.0)
    assert grid.count() == 200 * 84 and _parts(grid) == 8


def test_holt_fits_are_spread(spark):
    rows = [(k, f"2023-{m:02d}", float(k + m)) for k in range(40) for m in range(1, 4)]
    df = spark.createDataFrame(rows, "rep_id int, month_year string, rev double")
    assert _parts(fc.holt_forecast(df, ["rep_id"], "rev", 1)) > 4


def test_extracts_come_from_one_join(spark, tmp_out, monkeypatch):
    read, write = {}, sinks.write_csv

    def seen(df, path, *more):
        read[path.rsplit("/", 1)[1]] = " ".join(df.inputFiles())
        write(df, path, *more)

    monkeypatch.setattr(sinks, "write_csv", seen)
    jobs.extract_job(spark, "/root/testdata/sf0.001", tmp_out)
    assert not [name for name, files in read.items() if "lineitem" in files], read


def test_load_modes_read_the_loaded_revenue(spark, monkeypatch):
    read, load = [], versions.load

    def seen(session, df, root, table, *more):
        read.append((table, " ".join(df.inputFiles())))
        return load(session, df, root, table, *more)

    monkeypatch.setattr(versions, "load", seen)
    registry._io_load_modes(from_testdata(spark, "/root/testdata/sf0.001"))
    revenue = [files for table, files in read if table == "fact_revenue"]
    assert "lineitem" in revenue[0] and "lineitem" not in revenue[1]
